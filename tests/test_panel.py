"""Mapping, pools, dedup, countries, column sets."""

import pytest

from conftest import rows
from poolweave.operators.columns import align, header_union, non_empty_columns, union_aligned
from poolweave.operators.country import detect_country, first_rows
from poolweave.operators.mapping import (
    as_dict,
    forward_mapping,
    prepare_ecb,
    prepare_esma,
    reverse_mapping,
)
from poolweave.operators.pools import classify_pools, overlap_report, pending, pool_sizes
from poolweave.operators.prefer import prefer_source, removal_report
from poolweave.plans.universe_stage import universe


def template(spark, *entries):
    numbered = [(i, *e) for i, e in enumerate(entries)]
    return spark.createDataFrame(
        numbered, "position long, esma_code string, esma_name string, ecb_code string"
    )


def test_mapping_rules(spark):
    table = template(
        spark,
        ("R1", "Plain", "AR1"),
        ("R2", "First", "AR2"),
        ("R3", "Second", "AR2"),
        ("R4", "First", "AR3"),
        ("R5", "New one", "AR3"),
        ("R6", "Later", "AR3"),
        ("R7", "Newer", "AR3"),
        ("R8", "New first", "AR4"),
        ("R9", "After", "AR4"),
        ("R1", "Again", "AR9"),
        ("R10", "No code", None),
    )
    assert as_dict(forward_mapping(table)) == {
        "AR1": "R1", "AR2": "R2", "AR3": "R7", "AR4": "R8", "AR9": "R1",
    }
    assert dict(rows(reverse_mapping(table)))["R1"] == "AR9"


def test_prepare(strings):
    codes = {"AR1": "RREL6", "AR2": "RREL3"}
    ecb = prepare_ecb(strings("AR1 AR2 X", ("2020-05-31", "l", "x")), codes)
    assert ecb.columns == ["RREL6", "RREL3", "X", "source", "date_ym"]
    assert rows(ecb) == [("2020-05-31", "l", "x", "ECB", "2020-05")]
    unmapped = prepare_ecb(strings("AR1", ("2020-05-31",)), {})
    assert rows(unmapped) == [("2020-05-31", "ECB", "2020-05")]
    assert rows(prepare_esma(strings("A", ("1",)))) == [("1", "ESMA", "")]
    with pytest.raises(ValueError, match="one field code"):
        prepare_ecb(strings("AR1 AR2", ("1", "2")), {"AR1": "R", "AR2": "R"})


PANEL = [
    ("P", "ECB", "1", "2020-01", "covered"),
    ("P", "ECB", "1", "2020-02", "other month"),
    ("P", "ECB", None, "2020-01", "null covered"),
    ("P", "ECB", "2", None, "null month covered"),
    ("P", "ECB", "a|b", "2020-01", "pipe covered"),
    ("P", "ECB", "3", "2020-01", "kept"),
    ("P", "ECB", "3", "2020-01", "kept copy"),
    ("P", "ESMA", "1", "2020-01", "e"),
    ("P", "ESMA", "1", "2020-01", "e copy"),
    ("P", "ESMA", None, "2020-01", "e"),
    ("P", "ESMA", "2", None, "e"),
    ("P", "ESMA", "a|b", "2020-01", "e"),
    ("Q", "ECB", "1", "2020-01", "other pool"),
    ("Q", "ESMA", "1", "2020-01", "e"),
]


def test_prefer_source(strings):
    panel = strings("pool_id source RREL3 date_ym note", *PANEL)
    kept = prefer_source(panel, overlap_pools=["P"])
    expected = [r for r in PANEL if not (r[0] == "P" and r[4].endswith("covered"))]
    assert rows(kept) == sorted(expected, key=repr)
    everywhere = prefer_source(panel)
    assert everywhere.count() == len(expected) - 1
    assert prefer_source(panel.drop("RREL3")).count() == len(PANEL)


def test_removal_report(strings):
    panel = strings("pool_id source RREL3 date_ym note", *PANEL)
    assert rows(removal_report(panel, overlap_pools=["P"])) == [("P", 12, 8, 4), ("Q", 2, 2, 0)]
    assert rows(removal_report(panel)) == [("P", 12, 8, 4), ("Q", 2, 1, 1)]
    assert rows(overlap_report(panel, ["pool_id"]), "pool_id", "months") == [("P", 2), ("Q", 1)]


def test_pool_classes(strings):
    ecb = strings("pool_id", ("A",), ("A",), ("B",), ("C",))
    esma = strings("pool_id", ("x",), ("y",), ("z",))
    mapping = strings("ecb_pool_id esma_pool_id", ("A", "x"), ("B", "x"), ("D", "gone"))
    assert rows(classify_pools(ecb, esma, mapping)) == sorted(
        [
            ("A", "x", "matched"),
            ("B", "x", "matched"),
            ("D", "gone", "matched"),
            ("C", None, "ecb_only"),
            (None, "y", "esma_only"),
            (None, "z", "esma_only"),
        ],
        key=repr,
    )


def test_universe(strings):
    ecb = prepare_ecb(
        strings(
            "AR1 AR2 pool_id",
            ("2020-01-31", "1", "A"),
            ("2020-02-29", "1", "A"),
            ("2020-01-31", "1", "B"),
            ("2020-01-31", "1", "C"),
        ),
        {"AR1": "RREL6", "AR2": "RREL3"},
    )
    esma = prepare_esma(
        strings("RREL6 RREL3 pool_id", ("2020-01-01", "1", "x"), ("2020-01-01", "7", "y"))
    )
    mapping = strings("ecb_pool_id esma_pool_id", ("A", "x"), ("B", "x"))
    columns = ("bucket", "pool_id", "source", "RREL6", "esma_pool_id")
    expected = [
        ("matched", "A", "ECB", "2020-02-29", "x"),
        ("matched", "A", "ESMA", "2020-01-01", "x"),
        ("matched", "B", "ESMA", "2020-01-01", "x"),
        ("ecb_only", "C", "ECB", "2020-01-31", None),
        ("esma_only", "y", "ESMA", "2020-01-01", "y"),
    ]
    covered = {
        "A": ("matched", "A", "ECB", "2020-01-31", "x"),
        "B": ("matched", "B", "ECB", "2020-01-31", "x"),
    }
    for pools, kept in [("all", ""), ("auto", ""), (["A"], "B"), (["B"], "A"), ([], "AB")]:
        result = universe(ecb, esma, mapping, overlap_pools=pools)
        assert "date_ym" not in result.columns
        assert rows(result, *columns) == sorted(expected + [covered[k] for k in kept], key=repr)


def test_sizes_and_pending(spark, strings):
    files = spark.createDataFrame([("A", 60), ("A", 50), ("B", 100)], "pool_id string, length long")
    assert rows(pool_sizes(files, threshold=100)) == [("A", 2, 110, True), ("B", 1, 100, False)]
    todo = pending(strings("k", ("a",), ("b",), (None,)), strings("k", ("a",), (None,)), ["k"])
    assert rows(todo) == [("b",)]


def test_column_sets(strings):
    df = strings("g a b", ("1", "x", None), ("2", None, None), ("2", None, "y"))
    assert rows(non_empty_columns(df, ["g"])) == [("1", "a", 1), ("2", "b", 1)]
    assert align(df, ["b", "new", "g"]).columns == ["b", "new", "g"]
    merged = union_aligned([strings("b a", ("1", "2")), strings("c a", ("3", "4"))])
    assert merged.columns == ["a", "b", "c"]
    assert rows(merged) == [("2", "1", None), ("4", None, "3")]


def test_header_union(spark):
    headers = spark.createDataFrame(
        [("IT", ["b", "a"]), ("IT", ["a", "C"]), ("DE", ["z"])],
        "country string, header array<string>",
    )
    assert rows(header_union(headers, ["country"])) == [("DE", ["z"]), ("IT", ["C", "a", "b"])]


EVIDENCE = "pool_id position RREL81 RREL84 RREC6 RREL11 AR129 NPEL20 NPEL23"


@pytest.mark.parametrize(
    ("values", "country"),
    [
        (["it", "FR", "DE1", "ES1", "NL1", "PT", "BE"], "IT"),
        (["ITA", "fr", "DE1", "ES1", "NL1", "PT", "BE"], "FR"),
        ([None, "F1", "de1", "ES1", "NL1", "PT", "BE"], "DE"),
        ([None, None, "ND1", "ES1", "NL1", "PT", "BE"], "ND"),
        ([None, None, "1DE", "ES1", "NL1", "PT", "BE"], "ES"),
        ([None, None, "D", "ND1", "NL1", "PT", "BE"], "NL"),
        ([None, None, None, "ND1", "ND2", "PT", "BE"], "PT"),
        ([None, None, None, None, None, "PTX", "be"], "BE"),
        ([None] * 7, "UNKNOWN"),
    ],
)
def test_country_priority(strings, values, country):
    df = strings(EVIDENCE, ("P", "1", *values))
    assert rows(detect_country(df)) == [("P", country)]


def test_country_details(strings):
    df = strings(
        "pool_id position RREL81 RREC6",
        ("A", "1", None, "ND1"),
        ("A", "2", None, "DE1"),
        ("B", "1", "xxx", None),
        ("B", "2", "GB", None),
        ("B", "3", "UK", None),
        ("RMBMIT1", "1", None, None),
        ("RMBSpt1", "1", "1", "2"),
    )
    assert rows(detect_country(df)) == [
        ("A", "ND"), ("B", "GB"), ("RMBMIT1", "IT"), ("RMBSpt1", "PT"),
    ]
    assert rows(detect_country(df, exclude_no_data_everywhere=True))[0] == ("A", "DE")
    assert rows(detect_country(df, sample_rows=1))[1] == ("B", "UNKNOWN")
    assert rows(detect_country(df, aliases={"GB": "UK"}))[1] == ("B", "UK")
    assert rows(first_rows(df, ["pool_id"], ["position"], 1), "pool_id", "position") == [
        ("A", "1"), ("B", "1"), ("RMBMIT1", "1"), ("RMBSpt1", "1"),
    ]


def test_all_rows_are_looked_at(spark):
    late = [("P", i, "IT" if i == 101 else None) for i in range(1, 200)]
    df = spark.createDataFrame(late, "pool_id string, position long, RREL81 string")
    assert rows(detect_country(df)) == [("P", "IT")]
    assert rows(detect_country(df, sample_rows=100)) == [("P", "UNKNOWN")]
