"""Numbers of different values: exactly in two steps, or from stored sketches.

Several exact distinct counts in one aggregate repeat every row once per column with all
columns as a key. Here a row becomes one short entry per column; entries are reduced to
one per value first and counted then.

A sketch of a partition's values is a few kilobytes and is written beside the partition.
Sketches of partitions unite, so a report on countries, or on all months so far, reads
sketches and no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poolweave.functions.columns import col, cols

ACCURACY = 14  # 2**14 registers: a standard error of 0.8 %


def different_values(df: DataFrame, group: Sequence[str], values: dict[str, Column]) -> DataFrame:
    """``group…, entry, value``: every value of every entry once, missing ones included."""
    entries = F.array(
        *(F.struct(F.lit(k).alias("entry"), v.cast("string").alias("value")) for k, v in enumerate(values.values()))
    )
    listed = df.select(*cols(group), F.explode(entries).alias("__e")).select(*cols(group), "__e.*")
    return listed.distinct()


def exact_distinct(df: DataFrame, group: Sequence[str], values: dict[str, Column]) -> DataFrame:
    """Different non-missing values per group, one column for each entry of ``values``."""
    present = F.col("value").isNotNull()
    return different_values(df, group, values).groupBy(*cols(group)).agg(
        *(F.count_if(present & (F.col("entry") == k)).alias(name) for k, name in enumerate(values))
    )


def distinct_sketches(df: DataFrame, group: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``group…, column_name, rows, sketch``: to be written beside the partitions of ``group``."""
    sketches = [F.hll_sketch_agg(col(c).cast("string"), F.lit(ACCURACY)).alias(f"__sketch_{k}") for k, c in enumerate(columns)]
    made = df.groupBy(*cols(group)).agg(F.count(F.lit(1)).alias("rows"), *sketches)
    listed = F.array(
        *(F.struct(F.lit(c).alias("column_name"), F.col(f"__sketch_{k}").alias("sketch")) for k, c in enumerate(columns))
    )
    return made.select(*cols(group), "rows", F.explode(listed).alias("__s")).select(
        *cols(group), F.col("__s.column_name").alias("column_name"), "rows", F.col("__s.sketch").alias("sketch")
    )


def united_sketches(sketches: DataFrame, group: Sequence[str]) -> DataFrame:
    """Stored sketches brought to fewer, larger groups."""
    return sketches.groupBy(*cols(group), "column_name").agg(
        F.sum("rows").alias("rows"), F.hll_union_agg("sketch").alias("sketch")
    )


def estimates(sketches: DataFrame, group: Sequence[str]) -> DataFrame:
    """``group…, column_name, rows, distinct``: about how many values, from sketches alone."""
    return united_sketches(sketches, group).select(
        *cols(group), "column_name", "rows", F.hll_sketch_estimate("sketch").alias("distinct")
    )
