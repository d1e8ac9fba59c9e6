"""Column sets of pools and countries, and tables brought under one of them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolweave.functions.columns import col, cols, sorted_union


def non_empty_columns(df: DataFrame, group: Sequence[str]) -> DataFrame:
    """Columns with a value, per group: ``group…, column_name, values``.

    One pass over the data; a group is one row of counts before it is unpivoted.
    """
    measured = [c for c in df.columns if c not in set(group)]
    counts = df.groupBy(*cols(group)).agg(*(F.count(col(c)).alias(c) for c in measured))
    return counts.unpivot(cols(group), cols(measured), "column_name", "values").filter(
        F.col("values") > 0
    )


def column_lists(named: DataFrame, group: Sequence[str]) -> DataFrame:
    """Sorted column list per group from ``group…, column_name`` rows."""
    return named.groupBy(*cols(group)).agg(
        F.array_sort(F.collect_set("column_name")).alias("columns")
    )


def header_union(headers: DataFrame, group: Sequence[str]) -> DataFrame:
    """Sorted union of the headers per group, from ``group…, header`` (an array)."""
    named = headers.select(*cols(group), F.explode("header").alias("column_name"))
    return column_lists(named.distinct(), group)


def align(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly these columns in this order, missing ones null."""
    available = set(df.columns)
    return df.select(
        *(
            col(c) if c in available else F.lit(None).cast("string").alias(c)
            for c in columns
        )
    )


def union_aligned(tables: Sequence[DataFrame], sort_columns: bool = True) -> DataFrame:
    """Rows of all tables under the union of their columns."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    if sort_columns:
        merged = merged.select(*cols(sorted_union([merged.columns])))
    return merged
