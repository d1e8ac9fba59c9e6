"""Raw files: headers, null tokens, damaged gzip, configuration tables."""

import gzip
import io
import json
import zlib

import pytest
from pyspark.sql import functions as F

from conftest import rows, write_files
from poolweave.sources.lookups import read_pool_mapping, read_template
from poolweave.sources.manifest import (
    ecb_files,
    first_lines,
    list_files,
    merged_esma_files,
    parse_header,
    raw_esma_files,
    scanned_first_lines,
    with_headers,
)
from poolweave.sources.salvage import inflated, probe_gzip, recovered_lines, salvage
from poolweave.sources.one_scan import POSITION, VALUES, Place, field_rows, header_table
from poolweave.sources.scan import read_csv, scan_manifest


def test_manifests(spark, tmp_path):
    folder = write_files(
        tmp_path,
        {
            "1_RMB_UE_P_2020-01-31_1.csv": "a\n",
            "1_RMB_Collateral_P_2020-01-31_1.csv": "a\n1\n",
            "1_RMB_Other_P_2020-01-31_1.csv": "a\n",
            "2_RMB_UE_P_2020-01-31_1.csv": "a\n",
            "POOL1_2020.csv.gz": "x",
        },
    )
    assert rows(raw_esma_files(spark, folder), "category", "identifier") == [
        ("Collateral", "P"), ("UE", "P"),
    ]
    assert rows(ecb_files(spark, folder), "name", "pool_id", "length") == [
        ("POOL1_2020.csv.gz", "POOL1", 1)
    ]
    assert ("P",) in rows(merged_esma_files(spark, folder), "pool_id")
    assert list_files(spark, folder, "*.csv").count() == 4


BOM = "\ufeff"
HEADERS = {
    "one.csv": 'A,B\n1,"x,""y"""\n2,\n3,""\n4,NA\n007,"null"\n',
    "two.csv": "B,A\nb,a\n",
    "three.csv": "C,A,C\nc1,a,c2\n",
    "sp ace%+.csv": "A,B\n5,6\n",
    "headeronly.csv": "A,B,D\n",
    "windows.csv": "A,B\r\n8,9\r\n",
    "marked.csv": BOM + "A,B\n10,11\n",
}


def test_headers(spark, tmp_path):
    folder = write_files(tmp_path, HEADERS)
    files = list_files(spark, folder)
    paths = [r.path for r in files.collect()]
    headers = dict(rows(with_headers(files, paths), "name", "header_line"))
    assert headers == {n: t.splitlines()[0].removeprefix(BOM) for n, t in HEADERS.items()}
    opened, scanned = first_lines(files), scanned_first_lines(files, paths)
    clean = F.regexp_replace("header_line", r"^\uFEFF|\r$", "")
    assert rows(opened.select("path", clean)) == rows(scanned.select("path", clean))
    assert parse_header('C,"A,b",C') == ["C", "A,b", "C.1"]


def test_scan_of_mixed_headers(spark, tmp_path):
    folder = write_files(tmp_path, HEADERS)
    table = scan_manifest(list_files(spark, folder))
    data = ("A", "B", "C", "`C.1`", "file_name")
    assert rows(table, *data) == sorted(
        [
            ("1", 'x,"y"', None, None, "one.csv"),
            ("2", None, None, None, "one.csv"),
            ("3", None, None, None, "one.csv"),
            ("4", None, None, None, "one.csv"),
            ("007", None, None, None, "one.csv"),
            ("a", "b", None, None, "two.csv"),
            ("a", None, "c1", "c2", "three.csv"),
            ("5", "6", None, None, "sp ace%+.csv"),
            ("8", "9", None, None, "windows.csv"),
            ("10", "11", None, None, "marked.csv"),
        ],
        key=repr,
    )
    ordered = table.filter("file_name = 'one.csv'").orderBy("block_start", "row_place")
    assert [r.A for r in ordered.collect()] == ["1", "2", "3", "4", "007"]
    assert "D" in table.columns
    plain = scan_manifest(list_files(spark, folder, "one.csv"), null_tokens=(""), positions=False)
    assert rows(plain)[3:] == [("3", None), ("4", "NA")]


def test_many_headers_are_one_scan(spark, tmp_path):
    """The plan does not grow with the number of headers; neither does what is read twice."""
    few = write_files(tmp_path / "few", {f"f{i}.csv": f"A,X{i % 7}\n{i},x{i}\n" for i in range(7)})
    texts = {}
    for i in range(500):  # all different: order, repeats and width
        names = [f"X{i % 7}", "A", *(f"X{j % 7}" for j in range(i % 5))]
        names = names[i % len(names) :] + names[: i % len(names)] + [f"Y{i // 100}"] * (i // 7 % 3)
        texts[f"f{i}.csv"] = ",".join(names) + "\n" + ",".join(f"{n}-{k}" for k, n in enumerate(names)) + "\n"
    many = write_files(tmp_path / "many", texts)

    def scanned(folder):
        return scan_manifest(list_files(spark, folder), Place(folder))

    one, other = scanned(few), scanned(many)
    size = [len(t._jdf.queryExecution().optimizedPlan().toString().splitlines()) for t in (one, other)]
    assert size[0] == size[1]
    got = {r.file_name: r.asDict() for r in other.collect()}
    assert len(got) == 500
    for name, text in texts.items():
        header, line = text.splitlines()
        expected = dict(zip(parse_header(header), line.split(",")))
        row = {c: v for c, v in got[name].items() if v is not None and c not in POSITION}
        assert row == expected


def test_wrong_header_fails(spark, tmp_path):
    folder = write_files(tmp_path, {"a.csv": "A,B\n1,2\n", "b.csv": "B,A\n1,2\n"})
    with pytest.raises(Exception, match="header"):
        read_csv(spark, folder, ["A", "B"]).collect()


def test_reserved_names_are_refused(spark, tmp_path):
    folder = write_files(tmp_path, {"a.csv": "A,country\n1,2\n"})
    with pytest.raises(ValueError, match="country"):
        scan_manifest(list_files(spark, folder))
    assert scan_manifest(list_files(spark, folder), positions=False).count() == 1


def test_line_ends_inside_quotes(spark, tmp_path):
    folder = write_files(tmp_path, {"a.csv": 'A,B\n1,"two\nlines"\n2,x\n'})
    table = scan_manifest(list_files(spark, folder), multi_line=True)
    assert rows(table, "A", "B") == [("1", "two\nlines"), ("2", "x")]


def test_split_file_keeps_order(spark, tmp_path):
    text = "A\n" + "".join(f"{i:08d}\n" for i in range(20000))
    folder = write_files(tmp_path, {"big.csv": text})
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        table = scan_manifest(list_files(spark, folder))
        assert table.select("block_start").distinct().count() > 3
        ordered = table.orderBy("file_name", "block_start", "row_place")
        assert [int(r.A) for r in ordered.collect()] == list(range(20000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


TEXT = "AR1,AR2\n" + "".join(f"2020-01-31,loan{i}\n" for i in range(3000))


def gz_files(folder):
    folder.mkdir(parents=True, exist_ok=True)
    good = gzip.compress(TEXT.encode())
    half = len(TEXT) // 2
    raw = zlib.compressobj(wbits=-15)
    files = {
        "GOOD_1.gz": good,
        "CRC_1.gz": good[:-8] + b"\1\2\3\4" + good[-4:],
        "CUT_1.gz": good[: len(good) // 2],
        "PLAIN_1.gz": b"0123456789" + raw.compress(TEXT.encode()) + raw.flush(),
        "TWO_1.gz": gzip.compress(TEXT[:half].encode()) + gzip.compress(TEXT[half:].encode()),
        "JUNK_1.gz": b"this is no gzip file at all",
        "EMPTY_1.gz": b"",
        "NOTHING_1.gz": gzip.compress(b""),
    }
    for name, content in files.items():
        (folder / name).write_bytes(content)
    return files


def inflate(content: bytes) -> tuple[bytes, str | None]:
    errors: list[str] = []
    text = b"".join(inflated(content, errors))
    return text, errors[0] if errors else None


def test_inflate(tmp_path):
    found = {n: inflate(c) for n, c in gz_files(tmp_path).items()}
    assert found["GOOD_1.gz"] == (TEXT.encode(), None)
    assert found["TWO_1.gz"] == (TEXT.encode(), None)
    assert found["PLAIN_1.gz"] == (TEXT.encode(), "Not a gzipped file")
    assert found["NOTHING_1.gz"] == (b"", None)
    assert found["EMPTY_1.gz"] == (b"", None)
    plain, error = found["CUT_1.gz"]
    assert TEXT.encode().startswith(plain) and plain and "ended" in error
    assert found["CRC_1.gz"] == (TEXT.encode(), "CRC check failed")
    named = io.BytesIO()
    with gzip.GzipFile("with a name", "wb", fileobj=named) as member:
        member.write(b"A\n1\n")
    assert inflate(named.getvalue()) == (b"A\n1\n", None)
    assert inflate(named.getvalue() + b"tail") == (b"A\n1\n", "Trailing data")
    assert inflate(named.getvalue()[:9])[1] is not None


def test_probe_and_salvage(spark, tmp_path):
    files = gz_files(tmp_path)
    probed = {r.path.rsplit("/", 1)[1]: r for r in probe_gzip(spark, str(tmp_path)).collect()}
    assert set(probed) == set(files) - {"EMPTY_1.gz"}  # empty files are not listed
    sound = {n for n, r in probed.items() if r.error is None}
    assert sound == {"GOOD_1.gz", "TWO_1.gz", "NOTHING_1.gz"}
    assert probed["CUT_1.gz"].header_line == "AR1,AR2"

    damaged = [f"{tmp_path}/{n}" for n in ("PLAIN_1.gz", "CUT_1.gz", "CRC_1.gz")]
    lines = recovered_lines(spark, damaged)
    got = salvage(spark, damaged, ["AR1", "AR2"])
    counts = dict(rows(got.groupBy("file_name").count()))
    assert counts["PLAIN_1.gz"] == counts["CRC_1.gz"] == 3000
    whole = [f"loan{i}" for i in range(3000)]
    cut = got.filter("file_name = 'CUT_1.gz'").orderBy("row_place")
    loans = [r.AR2 for r in cut.collect()]
    assert loans and loans == whole[: len(loans)]
    assert lines.filter("line_number = 0").select("line").distinct().count() == 1
    assert got.select(F.every("salvaged")).first()[0] is True


def test_configuration(spark, tmp_path):
    header = "OTHER,FIELD CODE,FIELD NAME,For info: existing ECB or EBA NPL template field code"
    folder = write_files(
        tmp_path,
        {
            "template.csv": f'{header}\nx,RREL6,"Cut, off",AR1\ny,RREL3,Loan,AR2\nz,RREL9,None,\n',
            "mapping.json": json.dumps(
                {"pools": {"E1": {"esma_pool": "S1", "more": 1}, "E2": {"esma_pool": "S1"}}},
                indent=2,
            ),
        },
    )
    assert rows(read_template(spark, f"{folder}/template.csv"), "esma_code", "ecb_code") == [
        ("RREL3", "AR2"), ("RREL6", "AR1"), ("RREL9", None),
    ]
    mapping = read_pool_mapping(spark, f"{folder}/mapping.json")
    assert rows(mapping) == [("E1", "S1"), ("E2", "S1")]


def test_headers_of_compressed_files(spark, tmp_path):
    (tmp_path / "a.gz").write_bytes(gzip.compress(b"X,Y\n1,2\n"))
    (tmp_path / "b.csv").write_text("Z\n3\n")
    files = list_files(spark, str(tmp_path))
    assert rows(first_lines(files), "header_line") == [("X,Y",), ("Z",)]


def test_a_stream_is_never_held_whole():
    """Pieces of a large file come one by one, and so do pieces of its text."""
    text = b"a,b\n" + b"0" * (5 << 20)
    stored = gzip.compress(text, 1) + gzip.compress(b"\n1,2\n")

    class Counted(io.BytesIO):
        def read(self, n=-1):
            assert 0 < n <= 1 << 20
            return super().read(n)

    errors = []
    pieces = list(inflated(Counted(stored), errors))
    assert b"".join(pieces) == text + b"\n1,2\n" and not errors
    assert max(map(len, pieces)) <= 1 << 20


def test_paths_are_taken_apart_once_for_a_file(spark, tmp_path):
    names = ("a b+c%41.csv", "é=1.csv")
    folder = write_files(tmp_path / "odd + %20", {n: "x,y\n1,null\n2,\n" for n in names})
    files = with_headers(list_files(spark, folder), folder)
    headers = header_table(files).localCheckpoint()
    found = field_rows(Place(folder), files, headers)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "decode" not in plan and "regexp" not in plan
    # Few fields are compared in compiled code.
    assert "lambdafunction" not in plan
    expected = [(n, [v, None]) for n in names for v in "12"]
    assert rows(found, "file_name", VALUES) == sorted(expected, key=repr)
