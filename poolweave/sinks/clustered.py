"""Loan and collateral tables that are laid out by their join key.

Both tables are cut into the same number of buckets by the key, and each month is added
in that layout. The join then reads bucket by bucket and needs no shuffle of either
table. A key that holds very many rows would lie in one bucket, so tables with such a key
are joined with balanced tasks instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from poolweave.functions.columns import collateral_columns_to_drop, detect_join_key, join_key_error, overlap_renames
from poolweave.operators.collateral import join_collateral
from poolweave.operators.skew import HOT_ROWS, hot_keys
from poolweave.session import scratch_path


def write_clustered(df: DataFrame, name: str, key: str, buckets: int, *, path: str | None = None, mode: str = "errorifexists") -> None:
    """Write, or with ``mode="append"`` add, rows to a table of so many buckets of ``key``.

    The one shuffle here is the last these rows need. ``path`` is where the files lie, by
    default below the shared folder.
    """
    spread = df.repartition(buckets, key)
    writer = spread.write.mode(mode).bucketBy(buckets, key).sortBy(key)
    if mode != "append":
        writer = writer.option("path", path or scratch_path(df.sparkSession, name))
    writer.saveAsTable(name)


def join_clustered(spark: SparkSession, loans: str, collateral: str, *, hot_rows: int = HOT_ROWS) -> DataFrame:
    """As :func:`poolweave.operators.collateral.join_collateral`, on tables of one layout."""
    left, right = spark.table(loans), spark.table(collateral)
    keys = detect_join_key(left.columns, right.columns)
    if keys is None:
        raise ValueError(join_key_error(left.columns, right.columns))
    # Counted bucket by bucket, without a shuffle.
    if not all(hot_keys(t, [k], hot_rows).isEmpty() for t, k in ((left, keys[0]), (right, keys[1]))):
        return join_collateral(left, right, keys=keys, hot_rows=hot_rows)
    right = right.drop(*collateral_columns_to_drop(right.columns))
    renames = overlap_renames(left.columns, right.columns)
    right = right.withColumnsRenamed(renames)
    own = renames.get(keys[1], keys[1])
    return left.hint("merge").join(right, left[keys[0]] == right[own], "left")
