"""Checks of stored results, one job for all countries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poolweave.functions.columns import SORT_KEYS, cols, display_columns
from poolweave.operators.quality import (
    duplicate_groups,
    head,
    integrity_report,
    loans_per_pool,
    long_series,
    row_counts,
    sample_values,
    series_rows,
    sort_violations,
)
from poolweave.sources.footers import damaged_files
from poolweave.sources.tables import (
    STORAGE_CHUNK,
    STORAGE_ORDER,
    STORED_CHUNK_ROWS,
    output_sizes,
    partition_files,
    read_table,
    with_storage_position,
)

COUNTRY = ("country",)
CHUNKS_PER_TASK = 3
ERROR = "ERROR"
DUPLICATE_COLUMNS = ("RREL1", "Pool_Cutoff_Date", "RREL3", "RREC6", "source")


def check_order(
    spark: SparkSession, path: str, keys: Sequence[str] = SORT_KEYS, partition: str = "country"
) -> DataFrame:
    """``partition, rows, violations, status`` from the rows as they are stored.

    A task compares a few chunks, however many there are; the footers tell their number.
    """
    table = read_table(spark, path)
    tasks = table.count() // (CHUNKS_PER_TASK * STORED_CHUNK_ROWS) + 1
    found = sort_violations(
        with_storage_position(table), [partition], STORAGE_CHUNK, STORAGE_ORDER, keys, tasks
    )
    return found.withColumn(
        "status", F.when(F.col("violations") == 0, F.lit("PASS")).otherwise(F.lit("FAIL"))
    )


def check_sorted_output(
    spark: SparkSession,
    country_path: str,
    sorted_path: str,
    countries: Sequence[str] | None = None,
) -> DataFrame:
    """Compare the country table with its sorted copy.

    A country with a file that cannot be read has the status ERROR and the reason; the
    others are compared all the same.
    """
    errors = {}
    for path in (sorted_path, country_path):
        damage = damaged_files(spark, path, "country").groupBy("country").agg(F.min("error").alias("error"))
        errors |= {r.country: r.error for r in damage.collect()}  # countries are few
    before, after = (_readable(spark, path, set(errors)) for path in (country_path, sorted_path))
    report = integrity_report(before, after, COUNTRY, groups=countries)
    failed = [(c, ERROR, [f"{ERROR}: {e}"]) for c, e in errors.items() if countries is None or c in countries]
    rows = spark.createDataFrame(failed, "country string, status string, issues array<string>")
    return report.unionByName(rows, allowMissingColumns=True) if failed else report


def _readable(spark: SparkSession, path: str, without: set[str]) -> DataFrame:
    """The table without some countries, whose files are not even opened."""
    if not without:
        return read_table(spark, path)
    there = partition_files(spark, path, "country").select("country").distinct().collect()
    folders = [f"{path.rstrip('/')}/country={r.country}" for r in there if r.country not in without]
    return spark.read.option("mergeSchema", True).option("basePath", path).parquet(*folders)


def check_readable(spark: SparkSession, path: str) -> DataFrame:
    """Rows, columns, files and bytes of each country's output."""
    table = read_table(spark, path)
    sizes = output_sizes(spark, path, "country")
    return (
        row_counts(table, COUNTRY)
        .join(sizes, "country", "full")
        .withColumn("columns", F.lit(len(table.columns) - 1))
    )


def duplicates_on(df: DataFrame, date: str, rows: int = 50) -> DataFrame:
    """What makes rows of a loan differ on one date."""
    that_day = df.filter(F.col("Pool_Cutoff_Date") == date)
    counted = duplicate_groups(that_day, DUPLICATE_COLUMNS)
    return head(counted, ("RREL1", "RREL3", "RREC6", "source"), rows)


def largest_pools_on(df: DataFrame, date: str, rows: int = 10) -> DataFrame:
    """Loans and rows of the pools with the most rows on one date."""
    that_day = df.filter(F.col("Pool_Cutoff_Date") == date)
    pools = loans_per_pool(that_day, ("RREL1", "Pool_Cutoff_Date"))
    return pools.orderBy(F.desc("total_rows"), F.asc_nulls_last("RREL1")).limit(rows)


def one_series(df: DataFrame, more_than: int = 3) -> DataFrame:
    """One loan-collateral pair with several observations, in date order."""
    keys = SORT_KEYS[:2]
    chosen = head(long_series(df, keys, more_than), keys, 1)
    return series_rows(df, chosen, keys).orderBy(*cols(SORT_KEYS))


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """A few rows with the columns that identify them."""
    shown = display_columns(df.columns)
    return head(df.select(*cols(shown)), shown, rows)


def random_file(files: DataFrame, seed: str = "") -> DataFrame:
    """One file of a manifest, picked by hash."""
    return files.join(sample_values(files, "name", 1, seed), "name", "left_semi")
