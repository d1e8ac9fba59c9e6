"""The four stages on a small raw tree, and incremental runs."""

import gzip
import json
from pathlib import Path

import pytest

from conftest import rows, write_files
from poolweave.plans import full_run
from poolweave.plans.checks import check_order, check_readable, check_sorted_output
from poolweave.plans.collateral_stage import join_pairs
from poolweave.plans.universe_stage import read_ecb, read_esma
from poolweave.operators.mapping import prepare_ecb
from poolweave.sinks.tables import export_csv
from poolweave.sources.tables import read_statistics
from poolweave.streaming import incremental
from poolweave.streaming.incremental import process_available

ESMA = {
    # a pair with a null key on both sides, quotes, leading zeros and a clash
    "1_RMB_UE_POOLA_2020-01-31_1.csv": "Sec_Id,Pool_Cutoff_Date,RREL1,RREL2,RREL3,RREL6,RREL81,NOTE\n"
    'S,2020-01-31,A,007,L1,2020-01-31,fr,"x,""1"""\n'
    "S,2020-01-31,A,,L2,2020-01-31,FR,y\n"
    "S,2020-01-31,A,9,L3,2020-01-31,NA,z\n",
    "1_RMB_Collateral_POOLA_2020-01-31_1.csv": "Sec_Id,Pool_Cutoff_Date,RREC1,RREC2,RREC3,RREC6,NOTE\n"
    "S,2020-01-31,C,007,C1,DE1,n\nS,2020-01-31,C,007,C2,DE2,m\nS,2020-01-31,C,NULL,C3,DE3,o\n",
    # two collateral sequences: the later one counts
    "1_NPE_UE_POOLB_2020-02-29_3.csv": "NPEL2,RREL3,RREL6,NPEL20\n1,N1,2020-02-29,pt\n",
    "1_NPE_Collateral_POOLB_2020-02-29_9.csv": "NPEC2,RREC3\n1,old\n",
    "1_NPE_Collateral_POOLB_2020-02-29_10.csv": "NPEC2,RREC3\n1,new\n2,unused\n",
    # no key, no partner, another form
    "1_CRP_UE_POOLC_2020-02-29_1.csv": "CRPL3\nx\n",
    "1_CRP_Collateral_POOLC_2020-02-29_1.csv": "CRPC2\nx\n",
    "1_RMB_UE_POOLD_2020-02-29_1.csv": "RREL2\nx\n",
    "2_RMB_UE_POOLE_2020-02-29_1.csv": "RREL2\nx\n",
}
ECB_TEXT = {
    "EA_2020-01.gz": "AR1,AR2,AR7\n2020-01-15,L1,covered\n2020-02-15,L1,kept\n",
    "EA_2020-03.gz": "AR2,AR1,AR128\nL3,2020-01-15,IT1\nL9,2020-03-15,IT1\n",
    "RMBMES01_2020-01.gz": "AR1,AR2\n2020-01-15,X1\n",
}


def raw_tree(folder) -> full_run.Inputs:
    esma = write_files(folder / "esma", ESMA)
    ecb = folder / "ecb"
    ecb.mkdir()
    for name, text in ECB_TEXT.items():
        (ecb / name).write_bytes(gzip.compress(text.encode()))
    damaged = gzip.compress(b"AR1,AR2\n2020-05-15,D1\n2020-05-15,D2\n")
    (ecb / "EA_damaged.gz").write_bytes(damaged[:-8] + b"0000" + damaged[-4:])
    (ecb / "EB_junk.gz").write_bytes(b"no gzip")
    configuration = write_files(
        folder,
        {
            "template.csv": "FIELD CODE,FIELD NAME,"
            "For info: existing ECB or EBA NPL template field code\n"
            "RREL6,Date,AR1\nRREL3,Loan,AR2\nRREC6,Region,AR128\nRREL99,None,\n",
            "mapping.json": json.dumps({"pools": {"EA": {"esma_pool": "POOLA"}}}),
        },
    )
    return full_run.Inputs(
        esma, str(ecb), f"{configuration}/template.csv", f"{configuration}/mapping.json"
    )


def test_collateral_stage(spark, tmp_path):
    joined = join_pairs(spark, raw_tree(tmp_path).esma_folder)
    name_a = "1_RMB_UE_Collateral_POOLA_2020-01-31_1.csv"
    name_b = "1_NPE_UE_Collateral_POOLB_2020-02-29_3.csv"
    assert rows(joined.statistics) == [
        ("NPE", name_b, 1, 2, 1, 1, 0, "NPEL2=NPEC2", 6),
        ("RMB", name_a, 3, 3, 4, 2, 2, "RREL2=RREC2", 12),
    ]
    [(ue, collateral, error)] = rows(joined.failed)
    assert ue == "1_CRP_UE_POOLC_2020-02-29_1.csv" and collateral.startswith("1_CRP_Coll")
    assert error.startswith("No join key") and "CRPC2" in error
    assert rows(joined.rows, "merged_name", "RREL2", "RREL3", "RREC3", "NOTE", "NOTE_collateral") == sorted(
        [
            (name_a, "007", "L1", "C1", 'x,"1"', "n"),
            (name_a, "007", "L1", "C2", 'x,"1"', "m"),
            (name_a, None, "L2", None, "y", None),
            (name_a, "9", "L3", None, "z", None),
            (name_b, None, "N1", "new", None, None),
        ],
        key=repr,
    )
    assert "RREC1" not in joined.rows.columns


def test_stage_one_of_many_headers_is_one_join(spark, tmp_path):
    """Every pair has headers of its own; plan size and rows are as with one pair."""

    def tree(folder, n):
        texts = {}
        for i in range(n):
            stem = ("RREL2", "RREC2") if i % 3 else ("NPEL2", "NPEC2")
            extra = [f"X{j}" for j in range(i % 4)]
            loan = [*extra, stem[0], "NOTE"][:: 1 if i % 2 else -1]
            other = [stem[1], "NOTE", f"Y{i % 5}", "Sec_Id", "RREC1"][:: 1 if i % 7 else -1]
            value = lambda names, key, k: ",".join(str(k) if c == key else f"{c}{i}" for c in names)
            name = f"P{i}_2020-01-31_1.csv"
            texts[f"1_RMB_UE_{name}"] = "\n".join([",".join(loan), *(value(loan, stem[0], k) for k in (1, 2))]) + "\n"
            texts[f"1_RMB_Collateral_{name}"] = "\n".join([",".join(other), *(value(other, stem[1], k) for k in (2, 2, 3))]) + "\n"
        return write_files(folder, texts)

    one, many = (join_pairs(spark, tree(tmp_path / str(n), n)) for n in (12, 84))
    size = [len(j.rows._jdf.queryExecution().optimizedPlan().toString().splitlines()) for j in (one, many)]
    assert size[0] == size[1]
    found = many.rows.collect()
    assert len(found) == 84 * 3 and many.failed.count() == 0
    for r in found:
        i = int(r.pool_id[1:])
        key, other = ("RREL2", "RREC2") if i % 3 else ("NPEL2", "NPEC2")
        matched = r[key] == "2"
        assert r["NOTE"] == f"NOTE{i}" and r["NOTE_collateral"] == (f"NOTE{i}" if matched else None)
        assert r[f"Y{i % 5}"] == (f"Y{i % 5}{i}" if matched else None) and r[other] == ("2" if matched else None)
        assert [r[f"X{j}"] for j in range(3)] == [f"X{j}{i}" if j < i % 4 else None for j in range(3)]
    counts = ("ue_rows", "collateral_rows", "merged_rows", "matched_rows", "unmatched_rows")
    assert rows(many.statistics, *counts) == [(2, 3, 3, 2, 1)] * 84


def test_all_stages(spark, tmp_path):
    inputs, outputs = raw_tree(tmp_path), full_run.Outputs(str(tmp_path / "out"))
    full_run.run(spark, inputs, outputs, overlap_pools="auto")
    pairs = {p.parent.relative_to(outputs.merged).as_posix() for p in Path(outputs.merged).rglob("part-*")}
    assert pairs == {
        "asset_type=RMB/identifier=POOLA/date=2020-01-31", "asset_type=NPE/identifier=POOLB/date=2020-02-29",
    }

    pools = spark.read.parquet(outputs.pools)
    columns = ("bucket", "pool_id", "source", "RREL3", "RREL6", "RREC3")
    a = ("matched", "EA")
    assert rows(pools, *columns) == sorted(
        [
            (*a, "ECB", "L1", "2020-02-15", None),
            (*a, "ECB", "L9", "2020-03-15", None),
            (*a, "ECB", "D1", "2020-05-15", None),
            (*a, "ECB", "D2", "2020-05-15", None),
            (*a, "ESMA", "L1", "2020-01-31", "C1"),
            (*a, "ESMA", "L1", "2020-01-31", "C2"),
            (*a, "ESMA", "L2", "2020-01-31", None),
            (*a, "ESMA", "L3", "2020-01-31", None),
            ("ecb_only", "RMBMES01", "ECB", "X1", "2020-01-15", None),
            ("esma_only", "POOLB", "ESMA", "N1", "2020-02-29", "new"),
        ],
        key=repr,
    )
    assert rows(pools.filter("salvaged"), "RREL3") == [("D1",), ("D2",)]
    quarantined = rows(read_statistics(spark, outputs.path("quarantine")), "pool_id", "error")
    assert quarantined[0] == ("EA", "CRC check failed") and quarantined[1][0] == "EB"

    countries = rows(
        read_statistics(spark, outputs.path("pool_countries")), "bucket", "pool_id", "country"
    )
    assert countries == [
        ("ecb_only", "RMBMES01", "ES"), ("esma_only", "POOLB", "PT"), ("matched", "EA", "FR"),
    ]
    log = read_statistics(spark, outputs.path("merge_log"))
    assert rows(log, "country", "files_merged", "total_rows") == [
        ("ES", 1, 1), ("FR", 1, 8), ("PT", 1, 1),
    ]

    report = check_sorted_output(spark, outputs.countries, outputs.sorted)
    assert rows(report, "country", "status") == [(c, "PASS") for c in ("ES", "FR", "PT")]
    assert rows(check_order(spark, outputs.sorted), "violations") == [(0,)] * 3
    assert rows(check_readable(spark, outputs.sorted), "country", "rows") == [
        ("ES", 1), ("FR", 8), ("PT", 1),
    ]
    finished = full_run.finished(spark, outputs.pools, "pool_id")
    assert rows(finished, "pool_id") == [("EA",), ("POOLB",), ("RMBMES01",)]


def test_resume(spark, tmp_path):
    inputs, outputs = raw_tree(tmp_path), full_run.Outputs(str(tmp_path / "out"))
    full_run.run(spark, inputs, outputs, overlap_pools=["EA"], resume=True)
    assert spark.read.parquet(outputs.sorted).count() == 10

    def files(path: str, pattern: str) -> set[str]:
        return {str(p) for p in Path(path).rglob(f"{pattern}/part-*")}

    kept = files(outputs.pools, "pool_id=EA") | files(outputs.sorted, "country=FR")
    late = Path(inputs.ecb_folder) / "RMBSIT9_2020-01.gz"
    late.write_bytes(gzip.compress(b"AR1,AR2\n2020-01-15,I1\n"))
    full_run.run(spark, inputs, outputs, overlap_pools=["EA"], resume=True)
    assert rows(spark.read.parquet(outputs.sorted).filter("country = 'IT'"), "RREL3") == [("I1",)]
    assert spark.read.parquet(outputs.sorted).count() == 11
    assert kept <= files(outputs.pools, "pool_id=EA") | files(outputs.sorted, "country=FR")


def test_resume_reads_new_and_changed_files_of_finished_pools(spark, tmp_path):
    inputs, outputs = raw_tree(tmp_path), full_run.Outputs(str(tmp_path / "out"))
    (Path(inputs.ecb_folder) / "empty_2020.gz").write_bytes(b"")
    (Path(inputs.ecb_folder) / "notes.txt").write_text("x")
    full_run.run(spark, inputs, outputs, overlap_pools=["EA"])
    lost = {("1_RMB_UE_POOLE", "Name of another form")}
    unread = rows(read_statistics(spark, outputs.path("esma_quarantine")), "name", "error")
    assert {(n[:14].replace("2_", "1_", 1), e) for n, e in unread} == lost
    quarantine = dict(rows(read_statistics(spark, outputs.path("quarantine")), "path", "error"))
    assert {p.rsplit("/", 1)[1]: e for p, e in quarantine.items()} == {
        "EA_damaged.gz": "CRC check failed", "EB_junk.gz": "Not a gzipped file",
        "empty_2020.gz": "Empty file", "notes.txt": "Name of another form",
    }
    summary = rows(read_statistics(spark, outputs.path("universe_summary")), "bucket", "pools", "finished", "files")
    assert [s[:3] for s in summary] == [("ecb_only", 1, 1), ("esma_only", 1, 1), ("matched", 1, 1)]

    def stored(path: str, pattern: str) -> set[str]:
        return {str(p) for p in Path(path).rglob(f"{pattern}/part-*")}

    kept = stored(outputs.pools, "pool_id=POOLB") | stored(outputs.sorted, "country=PT")
    # A new file of a finished pool, and another file with other rows of the same number.
    (Path(inputs.ecb_folder) / "EA_2020-07.gz").write_bytes(gzip.compress(b"AR1,AR2\n2020-07-15,NEW\n"))
    (Path(inputs.ecb_folder) / "RMBMES01_2020-01.gz").write_bytes(gzip.compress(b"AR1,AR2\n2020-01-15,X2\n"))
    full_run.run(spark, inputs, outputs, overlap_pools=["EA"], resume=True)
    result = spark.read.parquet(outputs.sorted)
    assert ("NEW",) in rows(result.filter("country = 'FR'"), "RREL3")
    assert rows(result.filter("country = 'ES'"), "RREL3") == [("X2",)]
    assert result.count() == 11
    assert kept == stored(outputs.pools, "pool_id=POOLB") | stored(outputs.sorted, "country=PT")


def test_list_of_overlap_pools(spark, tmp_path):
    inputs, outputs = raw_tree(tmp_path), full_run.Outputs(str(tmp_path / "out"))
    full_run.run_collateral(spark, inputs, outputs)
    full_run.run_universe(spark, inputs, outputs)
    assert spark.read.parquet(outputs.pools).count() == 12
    full_run.run_universe(spark, inputs, outputs, overlap_pools=["EA"])
    assert spark.read.parquet(outputs.pools).count() == 10


def test_ecb_rows_and_csv_exchange(spark, tmp_path):
    inputs = raw_tree(tmp_path)
    ecb = read_ecb(spark, inputs.ecb_folder, {"AR1": "RREL6", "AR2": "RREL3"})
    assert rows(ecb.rows.groupBy("pool_id").count()) == [("EA", 6), ("RMBMES01", 1)]

    lists = export_csv(
        ecb.rows.drop("file_name", "block_start", "row_place"), str(tmp_path / "csv"), "pool_id"
    )
    assert dict(rows(lists))["RMBMES01"] == ["RREL3", "RREL6", "date_ym", "salvaged", "source"]
    [part] = (tmp_path / "csv" / "pool_id=RMBMES01").glob("part-*.csv")
    assert part.read_text().splitlines()[0] == "RREL3,RREL6,date_ym,salvaged,source"

    merged = write_files(
        tmp_path / "merged", {"1_RMB_UE_Collateral_POOLA_2020-01-31_1.csv": "RREL6,X\n2020-01-31,1\n"}
    )
    esma = read_esma(spark, merged)
    assert rows(esma, "pool_id", "date_ym", "source") == [("POOLA", "2020-01", "ESMA")]


def test_incremental_runs(spark, tmp_path):
    landing, output, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))

    def land(*data):
        schema = "pool_id string, source string, RREL3 string, date_ym string"
        spark.createDataFrame(list(data), schema).coalesce(1).write.mode("append").parquet(landing)

    def process():
        process_available(
            spark, landing, output, checkpoint, files_per_batch=1
        ).awaitTermination()
        return rows(spark.read.parquet(output), "pool_id", "source", "RREL3", "date_ym")

    land(("P", "ECB", "1", "2020-01"), ("P", "ECB", "2", "2020-01"), ("Q", "ECB", "1", "2020-01"))
    assert process() == [
        ("P", "ECB", "1", "2020-01"), ("P", "ECB", "2", "2020-01"), ("Q", "ECB", "1", "2020-01"),
    ]
    untouched = sorted(str(p) for p in (tmp_path / "out" / "pool_id=Q").glob("part-*"))
    # A late file of the preferred source takes away a row written before.
    land(("P", "ESMA", "1", "2020-01"))
    land(("R", "ECB", "5", "2020-02"))
    assert process() == [
        ("P", "ECB", "2", "2020-01"), ("P", "ESMA", "1", "2020-01"),
        ("Q", "ECB", "1", "2020-01"), ("R", "ECB", "5", "2020-02"),
    ]
    assert untouched == sorted(str(p) for p in (tmp_path / "out" / "pool_id=Q").glob("part-*"))
    assert len(process()) == 4


def test_a_batch_reads_the_files_of_its_pools_only(spark, tmp_path, monkeypatch):
    landing, output, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    read = []

    def spied(index, touched, pool, found=incremental.files_of):
        read.append(found(index, touched, pool))
        return read[-1]

    monkeypatch.setattr(incremental, "files_of", spied)

    def land(*data):
        schema = "pool_id string, source string, RREL3 string, date_ym string"
        spark.createDataFrame(list(data), schema).coalesce(1).write.mode("append").parquet(landing)
        process_available(spark, landing, output, checkpoint).awaitTermination()
        return rows(spark.read.parquet(output), "pool_id", "source", "RREL3", "date_ym")

    for k in range(3):
        land((f"P{k}", "ECB", "1", "2020-01"), ("Q", "ECB", str(k), "2020-01"))
    assert [len(files) for files in read] == [1, 2, 3]
    got = land(("P0", "ESMA", "1", "2020-01"))
    assert len(read[-1]) == 2  # its own file and the first one
    monkeypatch.setattr(incremental, "MAX_LISTED_FILES", 1)
    again = land(("P1", "ESMA", "9", "2020-01"))
    assert read[-1] is None
    expected = [("P0", "ESMA", "1", "2020-01"), ("P1", "ECB", "1", "2020-01"), ("P2", "ECB", "1", "2020-01")]
    expected += [("Q", "ECB", str(k), "2020-01") for k in range(3)]
    assert got == expected and again == sorted([*expected, ("P1", "ESMA", "9", "2020-01")])


def test_clashing_codes_fail(strings):
    with pytest.raises(ValueError, match="AR2"):
        prepare_ecb(strings("AR2 RREL3", ("1", "2")), {"AR2": "RREL3"})


def sort_statuses(spark, outputs):
    return rows(read_statistics(spark, outputs.path("sort_status")), "country", "status")


def test_reruns_neither_double_nor_miss_rows(spark, tmp_path):
    inputs, outputs = raw_tree(tmp_path), full_run.Outputs(str(tmp_path / "out"))
    full_run.run(spark, inputs, outputs, overlap_pools="all")
    first = spark.read.parquet(outputs.pools).count()
    assert sort_statuses(spark, outputs) == [(c, "success") for c in ("ES", "FR", "PT")]

    # A pool that arrives late enters its country; nothing else is written again.
    late = b"AR1,AR2\n2020-06-15,Y1\n"
    (tmp_path / "ecb" / "RMBMES02_2020-06.gz").write_bytes(gzip.compress(late))
    full_run.run(spark, inputs, outputs, overlap_pools="all", resume=True)
    for table in (outputs.pools, outputs.countries, outputs.sorted):
        assert spark.read.parquet(table).count() == first + 1
    assert sort_statuses(spark, outputs) == [("ES", "success"), ("FR", "skipped"), ("PT", "skipped")]
    log = read_statistics(spark, outputs.path("merge_log"))
    assert rows(log, "country", "files_merged", "status")[0] == ("ES", 2, "success")

    # A pool that loses its partner changes bucket and id; a full run leaves no old copy.
    (tmp_path / "mapping.json").write_text(json.dumps({"pools": {"OTHER": {"esma_pool": "NONE"}}}))
    full_run.run(spark, inputs, outputs, overlap_pools="all")
    pools = spark.read.parquet(outputs.pools)
    assert rows(pools.filter("bucket = 'matched'"), "pool_id") == []
    rows_of = pools.groupBy("source", "RREL3", "RREL6", "RREC3").count()
    assert rows_of.filter("count > 1").count() == 0
    assert spark.read.parquet(outputs.countries).count() == pools.count()
    assert spark.read.parquet(outputs.sorted).count() == pools.count()
