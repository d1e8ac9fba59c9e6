"""Queries of stage 1: collateral join, file names, pairs, batch statistics."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poolweave.catalog import views as v
from poolweave.catalog.registry import query
from poolweave.functions.names import (
    ecb_pool_id,
    esma_pool_id,
    merged_name,
    safe_pool_id,
    with_name_fields,
)
from poolweave.functions.nulls import RAW_FILE_NULL_TOKENS, apply_null_tokens
from poolweave.operators import collateral as ops
from poolweave.operators.skew import lookup_join
from poolweave.plans.checks import preview, random_file
from poolweave.sinks.clustered import join_clustered, write_clustered


_JOINED = f"""
SELECT u.*, c."RREC2", c."RREC3", c."NOTE" AS "NOTE_collateral"
FROM ({v.LOANS}) u LEFT JOIN ({v.COLLATERAL}) c ON u."RREL2" = c."RREC2"
"""


@query(_JOINED)
def ue_collateral_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.join_collateral(v.loans(spark, sf_dir), v.collateral(spark, sf_dir))


@query(_JOINED)
def ue_collateral_join_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same join on tables written by key in two steps, as months arrive; no shuffle."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = []
    for part, rows, key in (("loans", v.loans(spark, sf_dir), "RREL2"), ("collateral", v.collateral(spark, sf_dir), "RREC2")):
        name = f"{part}_{uuid.uuid4().hex}"
        early = F.pmod(F.xxhash64(key), F.lit(3)) > 0
        write_clustered(rows.filter(early), name, key, buckets)
        write_clustered(rows.filter(~early | F.col(key).isNull()), name, key, buckets, mode="append")
        names.append(name)
    joined = join_clustered(spark, *names)
    for name in names:
        spark.sql(f"DROP TABLE {name}")  # the name only; the join has found the files
    return joined


_PAIRED = f"""
SELECT u.*, c."NPEC2", c."NPEC3", c.found
FROM ({v.PAIRED_LOANS}) u LEFT JOIN (SELECT *, TRUE AS found FROM ({v.PAIRED_COLLATERAL})) c
ON u.pair_no = c.pair_no AND u."NPEL2" IS NOT DISTINCT FROM c."NPEC2"
"""


@query(_PAIRED)
def ue_collateral_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many pairs in one join; a missing key meets the missing keys of its pair."""
    return ops.join_collateral(
        v.paired_loans(spark, sf_dir),
        v.paired_collateral(spark, sf_dir),
        ["pair_no"],
        marker="found",
        match_null_keys=True,
    )


@query(
    f"""
SELECT u.*, c."NPEC2", c."NPEC3"
FROM ({v.PAIRED_LOANS}) u LEFT JOIN ({v.PAIRED_COLLATERAL}) c
ON u.pair_no = c.pair_no AND u."NPEL2" = c."NPEC2"
"""
)
def ue_collateral_pairs_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where a missing key meets nothing."""
    return ops.join_collateral(
        v.paired_loans(spark, sf_dir),
        v.paired_collateral(spark, sf_dir),
        ["pair_no"],
    )


@query(
    f"""
SELECT u.*, c."NPEC2", c."NPEC3"
FROM ({v.PAIRED_LOANS}) u LEFT JOIN ({v.PAIRED_COLLATERAL}) c
ON u.pair_no = c.pair_no AND u."NPEL2" = c."NPEC2"
"""
)
def ue_collateral_pairs_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a bound so low that keys are dealt out on both sides."""
    return ops.join_collateral(
        v.paired_loans(spark, sf_dir),
        v.paired_collateral(spark, sf_dir),
        ["pair_no"],
        hot_rows=3,
        fan_out=4,
    )


@query(
    """
SELECT l_orderkey, l_linenumber, l_suppkey, s_nationkey
FROM lineitem LEFT JOIN (SELECT s_suppkey, s_nationkey FROM supplier WHERE s_suppkey % 3 > 0)
ON l_suppkey = s_suppkey
"""
)
def lookup_without_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lookup taken as too large to broadcast: a shuffled join with salted hot keys."""
    lines = v.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    lookup = v.table(spark, sf_dir, "supplier").filter("s_suppkey % 3 > 0")
    return lookup_join(
        lines,
        lookup.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"),
        ["l_suppkey"],
        max_broadcast_rows=0,
        hot_rows=500,
        fan_out=4,
    )


_STATISTICS = f"""
SELECT u.pair_no, ue_rows, collateral_rows, merged_rows, matched_rows, unmatched_rows,
  'NPEL2=NPEC2' AS merge_keys
FROM (SELECT pair_no, count(*) AS ue_rows FROM ({v.PAIRED_LOANS}) GROUP BY pair_no) u
JOIN (SELECT pair_no, count(*) AS collateral_rows FROM ({v.PAIRED_COLLATERAL})
  GROUP BY pair_no) c ON u.pair_no = c.pair_no
JOIN (SELECT pair_no, count(*) AS merged_rows, count(found) AS matched_rows,
    count(*) - count(found) AS unmatched_rows FROM ({_PAIRED}) GROUP BY pair_no) m
  ON u.pair_no = m.pair_no
"""


def _statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.join_statistics(
        v.paired_loans(spark, sf_dir),
        v.paired_collateral(spark, sf_dir),
        ["pair_no"],
        ("NPEL2", "NPEC2"),
        match_null_keys=True,
    )


@query(_STATISTICS)
def ue_collateral_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _statistics(spark, sf_dir)


@query(
    f"""
SELECT CAST(sum(ue_rows) AS BIGINT) AS total_ue_rows_processed,
  CAST(sum(merged_rows) AS BIGINT) AS total_merged_rows,
  CAST(sum(matched_rows) AS BIGINT) AS rows_with_collateral_match
FROM ({_STATISTICS})
"""
)
def batch_row_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.row_totals(_statistics(spark, sf_dir))


@query(
    f"""
SELECT CASE WHEN pair_no % 3 = 0 THEN 'RMB' ELSE 'NPE' END AS asset_type, count(*) AS pairs
FROM ({_STATISTICS}) GROUP BY 1
"""
)
def batch_success_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = _statistics(spark, sf_dir).withColumn(
        "asset_type", F.when(F.col("pair_no") % 3 == 0, "RMB").otherwise("NPE")
    )
    return ops.success_by_type(typed)


@query(f"SELECT merge_keys, count(*) AS pairs FROM ({_STATISTICS}) GROUP BY merge_keys")
def batch_keys_used(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.keys_used(_statistics(spark, sf_dir))


@query(
    """
SELECT error, count(*) AS pairs FROM (
  SELECT 'No join key between the columns of loans and of collateral: [' || o_orderpriority
    || '], [' || o_orderstatus || '], file '
    || CAST(o_orderkey AS VARCHAR) AS error
  FROM orders) GROUP BY 1
"""
)
def batch_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    error = F.concat(
        F.lit("No join key between the columns of loans and of collateral: ["),
        "o_orderpriority",
        F.lit("], ["),
        "o_orderstatus",
        F.lit("], file "),
        v.text("o_orderkey"),
    )
    return ops.error_summary(v.table(spark, sf_dir, "orders").select(error.alias("error")))


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = v.file_names(spark, sf_dir)
    return with_name_fields(files, "name", matching_only=True)


@query(v.PARSED_NAMES)
def parse_filenames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir)


@query(f"SELECT name, replace(name, '_UE_', '_UE_Collateral_') AS merged FROM ({v.FILE_NAMES})")
def merged_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.file_names(spark, sf_dir).select("name", merged_name(F.col("name")).alias("merged"))


@query(
    f"""
WITH parsed AS ({v.PARSED_NAMES}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY asset_type, identifier, date
    ORDER BY CAST(sequence AS BIGINT) DESC, name DESC) AS place
  FROM parsed WHERE category = 'Collateral')
SELECT u.asset_type, u.identifier, u.date, u.name AS ue_name, c.name AS collateral_name
FROM parsed u JOIN ranked c ON u.asset_type = c.asset_type AND u.identifier = c.identifier
  AND u.date = c.date
WHERE u.category = 'UE' AND c.place = 1
"""
)
def file_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.pair_files(_parsed(spark, sf_dir))


@query(
    f"""
SELECT name, split_part(name, '_', 1) AS ecb_pool_id, split_part(name, '_', -3) AS esma_pool_id,
  translate('P/' || name || '\\x', '/\\', '__') AS safe
FROM ({v.FILE_NAMES})
"""
)
def pool_ids_from_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("name")
    return v.file_names(spark, sf_dir).select(
        "name",
        ecb_pool_id(name).alias("ecb_pool_id"),
        esma_pool_id(name).alias("esma_pool_id"),
        safe_pool_id(F.concat(F.lit("P/"), name, F.lit("\\x"))).alias("safe"),
    )


_RAW_TEXT = """
SELECT p_partkey, CASE p_size % 8 WHEN 0 THEN 'NA' WHEN 1 THEN '' WHEN 2 THEN 'null'
  WHEN 3 THEN '-1.#IND' WHEN 4 THEN 'Na' ELSE p_name END AS "RREC6", p_brand AS "RREL4"
FROM part
"""


@query(
    f"""
SELECT p_partkey, "RREL4", CASE WHEN "RREC6" NOT IN
  ({", ".join("'" + t + "'" for t in RAW_FILE_NULL_TOKENS)}) THEN "RREC6" END AS "RREC6"
FROM ({_RAW_TEXT})
"""
)
def null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size") % 8
    raw = v.table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(size == 0, "NA")
        .when(size == 1, "")
        .when(size == 2, "null")
        .when(size == 3, "-1.#IND")
        .when(size == 4, "Na")
        .otherwise(F.col("p_name"))
        .alias("RREC6"),
        F.col("p_brand").alias("RREL4"),
    )
    return apply_null_tokens(raw, RAW_FILE_NULL_TOKENS, ["RREC6", "RREL4"])


@query(
    f"""
SELECT "Sec_Id", "Pool_Cutoff_Date", "RREL2", "RREC2" FROM (
  SELECT u.*, c."RREC2" FROM ({v.LOANS}) u
  LEFT JOIN ({v.COLLATERAL}) c ON u."RREL2" = c."RREC2")
ORDER BY "Sec_Id", "Pool_Cutoff_Date", "RREL2", "RREC2" LIMIT 5
"""
)
def merged_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(ops.join_collateral(v.loans(spark, sf_dir), v.collateral(spark, sf_dir)))


@query(f"SELECT * FROM ({v.FILE_NAMES}) ORDER BY md5('7' || name), name LIMIT 1")
def random_merged_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return random_file(v.file_names(spark, sf_dir), seed="7")
