"""Tables of the lake and their CSV exports.

Tables are Parquet, partitioned by what later stages prune on. The commit protocol
of the writer keeps half-written output invisible. A full run replaces a table with all
its partitions, so that nothing stale stays; an addition replaces only the partitions
in its data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from poolweave.functions.columns import col, cols
from poolweave.functions.names import safe_pool_id
from poolweave.operators.columns import column_lists, non_empty_columns

PAIR_PARTITIONS = ("asset_type", "identifier", "date")
POOL_PARTITIONS = ("bucket", "pool_id")
COUNTRY_PARTITION = "country"


def _gathered(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Rows of a partition brought together for few files, large ones split again.

    A rebalance is cut by size at run time, so one huge pool does not end in one task.
    """
    return df.hint("rebalance", *partitions)


def _writer(
    df: DataFrame, partitions: Sequence[str], replace: bool = False
) -> DataFrameWriter:
    return (
        df.write.partitionBy(*partitions)
        .mode("overwrite")
        .option("partitionOverwriteMode", "static" if replace else "dynamic")
    )


def write_pairs(df: DataFrame, path: str) -> None:
    """Stage 1 output below ``asset_type=…/identifier=…/date=…``, as its files were paired."""
    _writer(_gathered(df, PAIR_PARTITIONS), PAIR_PARTITIONS, replace=True).parquet(path)


def write_pools(df: DataFrame, path: str, *, replace: bool = True) -> None:
    """Stage 2 output below ``bucket=…/pool_id=…``."""
    safe = df.withColumn("pool_id", safe_pool_id(F.col("pool_id")))
    _writer(_gathered(safe, POOL_PARTITIONS), POOL_PARTITIONS, replace).parquet(path)


def write_countries(
    df: DataFrame, path: str, *, compact: bool = False, replace: bool = True
) -> None:
    """Stage 3 output below ``country=…``.

    Rows come from the pool table, where a task reads one or few pools and therefore
    writes to one or few countries; no shuffle is needed for that. ``compact`` adds
    one where pools are very small.
    """
    rows = _gathered(df, [COUNTRY_PARTITION]) if compact else df
    _writer(rows, [COUNTRY_PARTITION], replace).parquet(path)


def write_sorted(ordered: DataFrame, path: str, *, replace: bool = True) -> None:
    """Stage 4 output: the files of a country in order, each sorted.

    ``ordered`` comes from ``sort_panel`` with the country as group and is written as
    it is; another shuffle would undo the order.
    """
    _writer(ordered, [COUNTRY_PARTITION], replace).parquet(path)


def export_sorted_csv(ordered: DataFrame, path: str) -> None:
    """The same as CSV with headers; part files of a country follow each other."""
    _writer(ordered, [COUNTRY_PARTITION]).option("header", True).option("quote", '"').option(
        "escape", '"'
    ).csv(path)


def export_whole_csv(df: DataFrame, path: str, partition: str) -> None:
    """CSV per joined pair, pool or country, all with the same columns."""
    _writer(_gathered(df, [partition]), [partition]).option("header", True).option(
        "escape", '"'
    ).csv(path)


def export_csv(df: DataFrame, path: str, partition: str) -> DataFrame:
    """CSV per pool or country, each with its own non-empty columns only.

    Pools with the same columns are written by one job. Returns the column lists.
    """
    lists = column_lists(non_empty_columns(df, [partition]), [partition])
    by_columns = (
        lists.groupBy("columns").agg(F.collect_list(col(partition)).alias("members")).collect()
    )
    for group in by_columns:
        rows = df.filter(col(partition).isin(list(group["members"]))).select(
            *cols(group["columns"]), col(partition)
        )
        export_whole_csv(rows, path, partition)
    return lists


def write_statistics(df: DataFrame, path: str) -> None:
    """A report as JSON lines."""
    df.write.mode("overwrite").json(path)
