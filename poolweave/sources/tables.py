"""Reading back what the sinks wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from poolweave.functions.columns import col
from poolweave.sources.manifest import list_files

STORED_CHUNK_ROWS = 100_000
STORAGE_CHUNK = ("part_number", "stored_file", "file_chunk")
STORAGE_ORDER = ("row_in_file",)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A table whose files may differ in their columns.

    With a known schema the footers of all files need not be merged first.
    """
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.option("mergeSchema", True).parquet(path)


def with_storage_position(table: DataFrame) -> DataFrame:
    """Add where each row is stored: part number, file, chunk and row in the file."""
    name = F.col("_metadata.file_name")
    row = F.col("_metadata.row_index")
    return table.select(
        "*",
        F.regexp_extract(name, r"part-(\d+)", 1).cast("long").alias("part_number"),
        name.alias("stored_file"),
        F.floor(row / STORED_CHUNK_ROWS).alias("file_chunk"),
        row.alias("row_in_file"),
    )


def partition_files(spark: SparkSession, path: str, *partitions: str) -> DataFrame:
    """Data files of a partitioned table with size and partition values."""
    files = list_files(spark, path, "part-*")
    values = {
        p: F.url_decode(
            F.replace(F.regexp_extract("path", f"/{p}=([^/]*)/", 1), F.lit("+"), F.lit("%2B"))
        )
        for p in partitions
    }
    return files.withColumns(values)


def output_sizes(spark: SparkSession, path: str, partition: str) -> DataFrame:
    """Bytes per partition, smallest first."""
    files = partition_files(spark, path, partition)
    return (
        files.groupBy(col(partition))
        .agg(F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("files"))
        .orderBy("bytes", partition)
    )


def read_statistics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path)
