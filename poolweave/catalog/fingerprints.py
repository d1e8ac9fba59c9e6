"""Queries of checksums in order, reconciliation and distinct sketches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poolweave.catalog import views as v
from poolweave.catalog.checks import DIFFERENCES, SORT_AND_TIES, damaged, row_text_sql, sound
from poolweave.catalog.registry import query
from poolweave.operators import sketches
from poolweave.operators.ordered_hash import BASES, PRIME, combined, ordered_checksum, range_hashes
from poolweave.operators.ordering import sort_panel
from poolweave.operators.reconcile import reconciled_differences
from poolweave.session import materialize, scratch_path
from poolweave.sources.footers import footer_counts

_FIELDS = ("RREC3", "RREL3", "RREL6", "source")


def _ordered_sql(source: str, order: str) -> str:
    """Each row's digests times the powers of its place, from two tables of powers."""
    step = [pow(b, 256, PRIME) for b in BASES]
    digest = "CAST(CAST('0x' || substr(md5({0}), {1}, 7) AS BIGINT) AS BIGINT)"
    text = row_text_sql(*_FIELDS)
    return f"""
WITH RECURSIVE low(k, b1, b2) AS (SELECT 0, 1::BIGINT, 1::BIGINT
  UNION ALL SELECT k + 1, b1 * {BASES[0]} % {PRIME}, b2 * {BASES[1]} % {PRIME} FROM low WHERE k < 255),
high(k, b1, b2) AS (SELECT 0, 1::BIGINT, 1::BIGINT
  UNION ALL SELECT k + 1, b1 * {step[0]} % {PRIME}, b2 * {step[1]} % {PRIME} FROM high WHERE k < 1023),
placed AS (SELECT pool_no, {digest.format(text, 1)} AS d1, {digest.format(text, 8)} AS d2,
  row_number() OVER (PARTITION BY pool_no ORDER BY {order}) - 1 AS place FROM ({source})),
weighed AS (SELECT pool_no, d1 * (l.b1 * h.b1 % {PRIME}) % {PRIME} AS w1, d2 * (l.b2 * h.b2 % {PRIME}) % {PRIME} AS w2
  FROM placed JOIN low l ON l.k = place % 256 JOIN high h ON h.k = place // 256)
SELECT pool_no, count(*) AS rows,
  CAST((sum(w1) % {PRIME}) * 2147483648 + sum(w2) % {PRIME} AS BIGINT) AS ordered_checksum
FROM weighed GROUP BY pool_no
"""


_ORDERED = _ordered_sql(v.PANEL_WITH_NULLS, SORT_AND_TIES)


@query(_ORDERED)
def ordered_row_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checksum of the sorted panel that tells its order, too."""
    panel = sort_panel(v.panel_with_nulls(spark, sf_dir), group=["pool_no"], break_ties=True)
    return ordered_checksum(panel, ["pool_no"], _FIELDS)


@query(_ORDERED)
def ordered_checksum_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from stored values of twice as many ranges, as a growing table keeps them."""
    panel = v.panel_with_nulls(spark, sf_dir)
    ranges = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = sort_panel(panel, group=["pool_no"], break_ties=True, partitions=ranges)
    return combined(materialize(range_hashes(ordered, ["pool_no"], _FIELDS), "range-hashes"), ["pool_no"])


@query(DIFFERENCES)
def reconciled_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differing rows found from sketches; equal rows stay where they are."""
    return reconciled_differences(sound(spark, sf_dir), damaged(spark, sf_dir))


@query(DIFFERENCES)
def reconciled_diff_overfull(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with sketches too small for most parts, which are compared row by row."""
    return reconciled_differences(sound(spark, sf_dir), damaged(spark, sf_dir), parts=16, cells=24)


_COLUMNS = ("RREL3", "RREC3", "RREL6", "source")
_EXACT = " UNION ALL ".join(
    f"""SELECT pool_no % 3 AS region, '{c}' AS column_name, count(*) AS rows, count(DISTINCT "{c}") AS exact,
    true AS near FROM ({v.PANEL_WITH_NULLS}) GROUP BY pool_no % 3"""
    for c in _COLUMNS
)


@query(_EXACT)
def distinct_from_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values per region from the stored sketches of its pools, next to the exact numbers.

    ``near``: the estimate is within four standard errors.
    """
    panel = v.panel_with_nulls(spark, sf_dir)
    stored = materialize(sketches.distinct_sketches(panel, ["pool_no"], _COLUMNS), "distinct-sketches")
    region = (F.col("pool_no") % 3).alias("region")
    found = sketches.estimates(stored.select(region, "column_name", "rows", "sketch"), ["region"])
    counted = sketches.exact_distinct(panel.select(region, *_COLUMNS), ["region"], {c: F.col(c) for c in _COLUMNS})
    exact = counted.unpivot(["region"], list(_COLUMNS), "column_name", "exact")
    close = F.abs(F.col("distinct") - F.col("exact")) <= F.greatest(F.lit(1), 0.04 * F.col("exact"))
    return found.join(exact, ["region", "column_name"]).select("region", "column_name", "rows", "exact", close.alias("near"))


@query(f"SELECT CAST(pool_no AS VARCHAR) AS pool_no, count(*) AS rows FROM ({v.PANEL_WITH_NULLS}) GROUP BY pool_no")
def rows_from_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per partition of a stored table, from the footers of its files."""
    path = scratch_path(spark, "pool-table")
    v.panel_with_nulls(spark, sf_dir).write.partitionBy("pool_no").parquet(path)
    counts = footer_counts(spark, path, "pool_no")
    return counts.withColumn("pool_no", F.col("pool_no").cast("string"))
