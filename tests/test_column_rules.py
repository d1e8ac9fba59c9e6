"""Rules on headers and file names."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from poolweave.functions.columns import (
    collateral_columns_to_drop,
    detect_join_key,
    display_columns,
    overlap_renames,
    require_distinct_by_case,
    sorted_union,
    unique_header,
)
from poolweave.functions.geo import pool_id_country, region_country, two_letter_country
from poolweave.functions.names import (
    ecb_pool_id,
    esma_pool_id,
    merged_name,
    safe_pool_id,
    with_name_fields,
)
from poolweave.functions.nulls import RAW_FILE_NULL_TOKENS, apply_null_tokens


@pytest.mark.parametrize(
    ("loans", "collateral", "expected"),
    [
        (["RREL2", "RREL3"], ["RREC2", "RREC3"], ("RREL2", "RREC2")),
        (["NPEL2"], ["NPEC1", "NPEC2"], ("NPEL2", "NPEC2")),
        (["CRPL2"], ["CRPC2"], ("CRPL2", "CRPC2")),
        (["RREL2", "NPEL2"], ["NPEC2", "RREC2"], ("RREL2", "RREC2")),
        (["AAAL2", "NPEL2"], ["NPEC2"], ("NPEL2", "NPEC2")),
        (["TOOLONGL2"], ["TOOLONGC2"], None),
        (["RREL2"], ["RRC2"], None),
        ([], [], None),
    ],
)
def test_join_key(loans, collateral, expected):
    assert detect_join_key(loans, collateral) == expected


def test_columns_to_drop():
    columns = ["Sec_Id", "RREC1", "RREC2", "LONGNAMEC1", "X"]
    assert collateral_columns_to_drop(columns) == ["Sec_Id", "RREC1"]


def test_overlap_suffix():
    assert overlap_renames(["A", "B"], ["B", "C"]) == {"B": "B_collateral"}
    with pytest.raises(ValueError, match="clash"):
        overlap_renames(["B", "B_collateral"], ["B"])


def test_unions_and_repeated_names():
    assert sorted_union([["b", "a"], ["c", "a"]]) == ["a", "b", "c"]
    assert unique_header(["x", "y", "x", "x"]) == ["x", "y", "x.1", "x.2"]
    assert unique_header(["x", "x.1", "x"]) == ["x", "x.1", "x.2"]


def test_case_clash():
    with pytest.raises(ValueError, match="case"):
        require_distinct_by_case(["a", "A"], case_sensitive=False)
    require_distinct_by_case(["a", "A"], case_sensitive=True)


def test_display_columns():
    columns = ["RREL2", "Sec_Id", "RREC2", "Z", "NPEL2", "NPEC2", "CRPL2"]
    assert display_columns(columns) == ["Sec_Id", "RREL2", "RREC2", "NPEL2", "NPEC2"]


def test_file_names(spark, strings):
    names = strings(
        "name",
        ("1_RMB_UE_POOL_A_2021-04-30_29907.csv",),
        ("1_CRP_X_Collateral_P_2021-04-30_1.csv",),
        ("1_RMB_UE_Collateral_P_2021-04-30_1.csv",),
        ("2_RMB_UE_P_2021-04-30_1.csv",),
        ("1_RMB_UE_P_2021-04-30.csv",),
    )
    fields = with_name_fields(names, "name").drop("name")
    assert [tuple(r) for r in fields.collect()] == [
        ("RMB", "UE", "POOL_A", "2021-04-30", "29907"),
        ("CRP_X", "Collateral", "P", "2021-04-30", "1"),
        ("RMB_UE", "Collateral", "P", "2021-04-30", "1"),
        (None,) * 5,
        (None,) * 5,
    ]
    ids = names.limit(1).select(
        ecb_pool_id(F.col("name")), esma_pool_id(F.col("name")), merged_name(F.col("name"))
    )
    assert tuple(ids.first()) == (
        "1",
        "A",
        "1_RMB_UE_Collateral_POOL_A_2021-04-30_29907.csv",
    )
    odd = strings("name", ("a_b",), ("x_UE_y_UE_z",), ("p/q\\r",)).select(
        esma_pool_id(F.col("name")), merged_name(F.col("name")), safe_pool_id(F.col("name"))
    )
    assert [tuple(r) for r in odd.collect()] == [
        (None, "a_b", "a_b"),
        ("y", "x_UE_Collateral_y_UE_Collateral_z", "x_UE_y_UE_z"),
        (None, "p/q\\r", "p_q_r"),
    ]


def test_country_values(strings):
    values = strings("v", ("it",), ("ITA",), ("I1",), ("ND1",), ("de21",), ("É1",), ("öé",), (None,))
    found = values.select(
        two_letter_country(F.col("v")),
        region_country(F.col("v"), exclude_no_data=False),
        region_country(F.col("v"), exclude_no_data=True),
    )
    assert [tuple(r) for r in found.collect()] == [
        ("IT", "IT", "IT"),
        (None, "IT", "IT"),
        (None, None, None),
        (None, "ND", None),
        (None, "DE", "DE"),
        (None, None, None),
        ("ÖÉ", "ÖÉ", "ÖÉ"),
        (None, None, None),
    ]
    ids = strings("p", ("RMBMIT0001",), ("RMBSfr",), ("RMBM12",), ("XXXXIT",), ("RMBM",))
    assert [r[0] for r in ids.select(pool_id_country(F.col("p"))).collect()] == [
        "IT",
        "FR",
        None,
        None,
        None,
    ]


def test_null_tokens(strings):
    df = strings("a b", ("NA", "NA"), ("", "x"), ("Na", None), ("007", "null"))
    cleaned = apply_null_tokens(df, RAW_FILE_NULL_TOKENS, ["a"])
    assert rows(cleaned) == sorted(
        [(None, "NA"), (None, "x"), ("Na", None), ("007", "null")], key=repr
    )
    assert len(RAW_FILE_NULL_TOKENS) == 19


def test_null_tokens_in_many_columns(spark):
    names = [f"c{i}" for i in range(60)] + ["x.1"]
    values = ["NA" if i % 3 == 0 else None if i % 3 == 1 else str(i) for i in range(61)]
    df = spark.createDataFrame([(7, *values)], "n int, " + ", ".join(f"`{n}` string" for n in names))
    cleaned = apply_null_tokens(df, RAW_FILE_NULL_TOKENS, names)
    assert cleaned.columns == ["n", *names]
    assert tuple(cleaned.first()) == (7, *(str(i) if i % 3 == 2 else None for i in range(61)))
