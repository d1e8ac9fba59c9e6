"""What the footers of stored files say: row counts without a column read, and damage."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poolweave.functions.columns import col
from poolweave.session import materialize
from poolweave.sources.manifest import OPENED_BY_TASKS, open_file, scheme_of
from poolweave.sources.tables import partition_files

# The newer Parquet reader answers counts from footers; a session of its own keeps the
# settings away from other queries.
_SETTINGS = {
    "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text",
    "spark.sql.parquet.aggregatePushdown": "true",
}
MAGIC = b"PAR1"
NOT_PARQUET = "Not a Parquet file"


def counting_plan(spark: SparkSession, path: str, partition: str) -> DataFrame:
    """``partition, rows`` in a session whose scan reads footers only."""
    session = spark.newSession()
    for name, value in {**_SETTINGS, "spark.sql.caseSensitive": spark.conf.get("spark.sql.caseSensitive")}.items():
        session.conf.set(name, value)
    table = session.read.parquet(path)
    return table.groupBy(col(partition)).agg(F.count(F.lit(1)).alias("rows"))


def footer_counts(spark: SparkSession, path: str, partition: str) -> DataFrame:
    """Rows of each partition of a Parquet table, from the footers of its files."""
    counted = materialize(counting_plan(spark, path, partition), "footer-counts")
    return spark.read.schema(counted.schema).parquet(*counted.inputFiles())


def damaged_files(spark: SparkSession, path: str, partition: str) -> DataFrame:
    """``partition, path, error`` of the files that do not end like Parquet.

    Tasks look at the first and last bytes. Stores that only Spark opens are not looked at.
    """

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            errors = [_error(r.path, r.length) for r in batch.itertuples()]
            yield batch.assign(error=errors)[[partition, "path", "error"]].dropna(subset=["error"])

    files = partition_files(spark, path, partition).filter(scheme_of(F.col("path")).isin(*OPENED_BY_TASKS))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = files.select(partition, "path", "length").repartition(tasks, "path")
    return spread.mapInPandas(probe, f"`{partition}` string, path string, error string")


def _error(path: str, length: int) -> str | None:
    with open_file(path) as stream:
        first = stream.read(len(MAGIC))
        # A stream skips to the end without keeping what it passes.
        last, left = first, length - len(first)
        while left > 0 and (piece := stream.read(min(left, 1 << 20))):
            last, left = (last + piece)[-len(MAGIC) :], left - len(piece)
    return None if first == MAGIC and last == MAGIC and length > 2 * len(MAGIC) else NOT_PARQUET
