"""Stage 1: loan files joined to their collateral files.

All files are read in one scan as numbered fields, and all pairs meet in one join. What
differs between headers is in a small table of header pairs, made in tasks: the fields
of the two join keys, and for each column the field that holds it. So the plan stays as
it is however many headers there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poolweave.functions.columns import (
    collateral_columns_to_drop,
    detect_join_key,
    join_key_error,
    overlap_renames,
    require_distinct_by_case,
    require_unreserved,
)
from poolweave.functions.names import esma_pool_id, merged_name
from poolweave.operators.collateral import join_statistics, pair_files
from poolweave.operators.skew import balanced_left_join, lookup_join
from poolweave.session import materialize
from poolweave.sources.manifest import raw_esma_files, with_headers
from poolweave.sources.one_scan import (
    PIPELINE_COLUMNS,
    POSITION,
    VALUES,
    Place,
    column_names,
    field_rows,
    header_table,
    picked,
    place_of_each,
)

PAIR = ("asset_type", "identifier", "date", "ue_name")
_PATTERN = "1_*.csv"

STATISTICS_SCHEMA = (
    "asset_type string, filename string, ue_rows long, collateral_rows long, "
    "merged_rows long, matched_rows long, unmatched_rows long, merge_keys string, "
    "merged_cols int"
)
FAILED_SCHEMA = "ue string, collateral string, error string"


@dataclass
class JoinedPairs:
    """Result of stage 1.

    ``rows`` has the data of all pairs with ``merged_name`` and ``pool_id``,
    ``statistics`` one row per joined pair, ``failed`` one per pair without a key.
    """

    rows: DataFrame | None
    statistics: DataFrame
    failed: DataFrame


def file_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of files with path and header line of both."""
    return _pairs(_manifest(spark, folder))


def _manifest(spark: SparkSession, folder: str) -> DataFrame:
    files = materialize(raw_esma_files(spark, folder), "esma-files")
    return materialize(with_headers(files, folder, _PATTERN), "esma-headers")


def _pairs(files: DataFrame) -> DataFrame:
    headers = files.select("name", "path", "header_line")

    def named(prefix: str) -> DataFrame:
        return headers.toDF(f"{prefix}_name", f"{prefix}_path", f"{prefix}_header")

    return pair_files(files).join(named("ue"), "ue_name").join(named("collateral"), "collateral_name")


def join_pairs(spark: SparkSession, folder: str) -> JoinedPairs:
    """Join all pairs of a folder in one join; the pair is part of the key.

    A pair of headers without a join key fails its own pairs and no others. Loans of
    several sequences meet the same collateral, each on their own. A collateral file
    whose key depends on the loan file it meets takes part once for each such key.
    """
    files = _manifest(spark, folder)
    pairs = materialize(_pairs(files), "pairs")
    headers = materialize(header_table(files), "headers")
    rules = materialize(_header_pairs(pairs, headers), "header-pairs")
    same = pairs["ue_header"].eqNullSafe(rules["ue_header"]) & pairs["collateral_header"].eqNullSafe(
        rules["collateral_header"]
    )
    ruled = materialize(
        pairs.join(rules.withColumn("merged_cols", F.size("names")).drop("names", "sides", "fields"), same).drop(rules["ue_header"]).drop(rules["collateral_header"]),
        "ruled-pairs",
    )
    failed = ruled.filter(F.col("error").isNotNull()).select(
        F.col("ue_name").alias("ue"), F.col("collateral_name").alias("collateral"), "error"
    )
    good = ruled.filter(F.col("error").isNull())
    if good.isEmpty():
        return JoinedPairs(None, spark.createDataFrame([], STATISTICS_SCHEMA), failed)

    # Text is parsed once; counts, statistics and join read the landed rows.
    place = Place(folder, _PATTERN)
    landed = materialize(field_rows(place, files, headers).drop("header_id"), "landed")
    names = column_names(rules.filter("error IS NULL").withColumnRenamed("rule", "header_id"))
    require_distinct_by_case(names, spark.conf.get("spark.sql.caseSensitive") == "true")
    loan_names = column_names(headers.join(good.select(F.col("ue_header").alias("header_line")).distinct(), "header_line"))
    require_unreserved([*names, *loan_names], (*POSITION, *PIPELINE_COLUMNS))

    loan_files = good.select(
        *PAIR, "rule", "ue_key", "collateral_key", F.col("collateral_name").alias("__collateral"),
    )
    loans = lookup_join(
        landed.withColumnRenamed("file_name", "ue_name"), materialize(loan_files, "loan-files"), ["ue_name"], "inner", null_safe=False
    ).withColumn("__loan_key", F.get(VALUES, F.col("ue_key")))
    collateral_files = good.select(F.col("collateral_name").alias("file_name"), "collateral_key").distinct()
    collateral = lookup_join(
        landed.select("file_name", VALUES), materialize(collateral_files, "collateral-files"), ["file_name"], "inner", null_safe=False
    ).select(
        F.col("file_name").alias("__c_file"),
        F.col("collateral_key").alias("__c_place"),
        F.get(VALUES, F.col("collateral_key")).alias("__collateral_key"),
        F.col(VALUES).alias("__c_values"),
    )
    on = [("__collateral", "__c_file"), ("collateral_key", "__c_place"), ("__loan_key", "__collateral_key")]
    joined = balanced_left_join(loans, collateral, on, marker="__found", null_safe=False)
    return JoinedPairs(_named(joined, rules, names), _pair_statistics(loans, collateral, good), failed)


def _header_pairs(pairs: DataFrame, headers: DataFrame) -> DataFrame:
    """For every pair of headers the join key and where each column of the result lies.

    ``ue_key`` and ``collateral_key`` are fields; ``names`` are columns, ``sides`` 0 for
    the loans and 1 for the collateral, ``fields`` their places there.
    """

    def rule(row) -> tuple:
        if row.ue_names is None or row.collateral_names is None:
            return ("No columns to parse from file", None, None, None, [], [], [])
        loans, collateral = list(row.ue_names), list(row.collateral_names)
        keys = detect_join_key(loans, collateral)
        if keys is None:
            return (join_key_error(loans, collateral), None, None, None, [], [], [])
        dropped = set(collateral_columns_to_drop(collateral))
        own = [c for c in collateral if c not in dropped]
        renames = overlap_renames(loans, own)
        names = loans + [renames.get(c, c) for c in own]
        sides = [0] * len(loans) + [1] * len(own)
        fields = [*range(len(loans)), *(collateral.index(c) for c in own)]
        return (None, loans.index(keys[0]), collateral.index(keys[1]), "=".join(keys), names, sides, fields)

    def rule_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["error", "ue_key", "collateral_key", "merge_keys", "names", "sides", "fields"]
        for batch in batches:
            found = pd.DataFrame([rule(r) for r in batch.itertuples()], columns=columns)
            kept = batch[["rule", "ue_header", "collateral_header"]].reset_index(drop=True)
            yield pd.concat([kept, found.astype({"ue_key": "Int32", "collateral_key": "Int32"})], axis=1)

    different = pairs.groupBy("ue_header", "collateral_header").agg(F.count(F.lit(1)).alias("files"))
    known = headers.select("header_line", F.col("names"))
    both = (
        different.join(known.toDF("ue_header", "ue_names"), "ue_header", "left")
        .join(known.toDF("collateral_header", "collateral_names"), "collateral_header", "left")
        .withColumn("rule", F.monotonically_increasing_id())
        .select("rule", "ue_header", "collateral_header", "ue_names", "collateral_names")
    )
    return both.mapInPandas(
        rule_all,
        "rule long, ue_header string, collateral_header string, error string, ue_key int, collateral_key int, "
        "merge_keys string, names array<string>, sides array<int>, fields array<int>",
    )


def _named(joined: DataFrame, rules: DataFrame, names: list[str]) -> DataFrame:
    """Every column from the side and field where the row's headers have it."""
    place = place_of_each(names, F.col("names"))

    def fields_of(side: int):
        def field(p):
            return F.when(F.get("sides", p.cast("int")) == side, F.get("fields", p.cast("int"))).otherwise(-1)

        return F.transform(place, field)

    placed = rules.filter("error IS NULL").select("rule", fields_of(0).alias("__loan_places"), fields_of(1).alias("__c_places"))
    rows = lookup_join(joined, materialize(placed, "rule-places"), ["rule"], "inner", null_safe=False)
    both = F.zip_with(picked(F.col(VALUES), F.col("__loan_places")), picked(F.col("__c_values"), F.col("__c_places")), lambda a, b: F.coalesce(a, b))
    out = rows.select(*PAIR, "block_start", "row_place", both.alias(VALUES))
    return out.select(
        *PAIR, "block_start", "row_place", *(F.col(VALUES)[k].alias(n) for k, n in enumerate(names))
    ).withColumns({"merged_name": merged_name(F.col("ue_name")), "pool_id": esma_pool_id(merged_name(F.col("ue_name")))})


def _pair_statistics(loans: DataFrame, collateral: DataFrame, good: DataFrame) -> DataFrame:
    """Statistics per loan file. Collateral is repeated for each loan file of its key."""
    met = good.select(*PAIR, F.col("collateral_name").alias("__c_file"), F.col("collateral_key").alias("__c_place"))
    repeated = lookup_join(
        collateral.select("__c_file", "__c_place", "__collateral_key"), materialize(met, "pair-names"), ["__c_file", "__c_place"],
        "inner", null_safe=False,
    )
    stats = join_statistics(
        loans.select(*PAIR, "__loan_key"), repeated.select(*PAIR, "__collateral_key"), PAIR, ("__loan_key", "__collateral_key")
    ).drop("merge_keys")
    columns = good.select("ue_name", "merge_keys", "merged_cols")
    return lookup_join(stats, materialize(columns, "pair-columns"), ["ue_name"], "inner", null_safe=False).select(
        "asset_type", merged_name(F.col("ue_name")).alias("filename"), "ue_rows", "collateral_rows", "merged_rows",
        "matched_rows", "unmatched_rows", "merge_keys", "merged_cols",
    )
