"""Incremental stage 2: recompute the pools that new files touch.

Neither the dedup nor the country of a pool can be extended by appending: a late ESMA
file takes away ECB rows that are already written. Each batch of new rows therefore
names the pools to redo, and those are recomputed from all of their rows and replace
their partitions.

An index notes which landed files have rows of a pool. Each batch adds its own part to
it and then reads the files of its pools only, so that what a batch reads grows with
those pools and not with the landing folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from poolweave.functions.columns import col, cols
from poolweave.operators.prefer import prefer_source
from poolweave.operators.skew import lookup_join
from poolweave.session import materialize

MAX_FILTER_POOLS = 1000
MAX_LISTED_FILES = 10_000  # with more the whole folder is read and filtered
LANDED_FILE = "__landed_file"


def landed_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    names: str = "*",
    files_per_batch: int | None = None,
) -> DataFrame:
    """New Parquet files of a landing folder as a stream; ``names`` is a pattern."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", names)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def refresh_pools(
    new_rows: DataFrame,
    read_all: Callable[[], DataFrame],
    output: str,
    pool: Sequence[str] = ("pool_id",),
    *,
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Recompute the pools of ``new_rows`` from everything landed so far."""
    touched = materialize(new_rows.select(*cols(pool)).distinct(), "touched")
    rows = _rows_of(read_all(), touched, pool)
    result = transform(rows) if transform else prefer_source(rows, pool)
    (
        result.hint("rebalance", *pool)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*pool)
        .parquet(output)
    )


def note_files(batch: DataFrame, index: str, batch_id: int, pool: Sequence[str]) -> None:
    """Add the files of a batch to the index; a repeated batch replaces its part."""
    noted = batch.select(*cols(pool), LANDED_FILE).distinct()
    noted.write.mode("overwrite").parquet(f"{index.rstrip('/')}/batch={batch_id}")


def files_of(index: str, touched: DataFrame, pool: Sequence[str]) -> list[str] | None:
    """The landed files with rows of the touched pools; ``None`` if they are too many to list."""
    noted = touched.sparkSession.read.parquet(index).select(*cols(pool), LANDED_FILE)
    found = lookup_join(noted, touched, pool, "left_semi").select(LANDED_FILE).distinct()
    files = [r[0] for r in found.limit(MAX_LISTED_FILES + 1).collect()]
    return files if len(files) <= MAX_LISTED_FILES else None


def _rows_of(rows: DataFrame, touched: DataFrame, pool: Sequence[str]) -> DataFrame:
    """Rows of the touched pools: by a filter the scan can use while they are few."""
    few = touched.limit(MAX_FILTER_POOLS + 1).collect() if len(pool) == 1 else []
    if 0 < len(few) <= MAX_FILTER_POOLS and all(r[0] is not None for r in few):
        return rows.filter(col(pool[0]).isin([r[0] for r in few]))
    return lookup_join(rows, touched, pool, "left_semi")


def process_available(
    spark: SparkSession,
    landing: str,
    output: str,
    checkpoint: str,
    pool: Sequence[str] = ("pool_id",),
    *,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    names: str = "*",
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Work through all files that arrived since the last run, then stop.

    ``prepare`` makes panel rows of landed rows; ``transform`` is what is computed
    over all rows of a pool, by default the dedup.

    The checkpoint remembers the files, and ``pool_files`` below it the pools in each of
    them; files that were landed before there was an index are read every time. A batch
    that is repeated after a failure replaces the same partitions with the same rows.
    """
    index = f"{checkpoint.rstrip('/')}/pool_files"

    def landed(session: SparkSession) -> DataFrameReader:
        return session.read.option("pathGlobFilter", names)

    schema = landed(spark).parquet(landing).schema

    def prepared(rows: DataFrame) -> DataFrame:
        return prepare(rows) if prepare else rows

    indexed = _indexed_from_the_start(spark, index, checkpoint)

    def refresh(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        rows = prepared(batch)
        if not indexed or LANDED_FILE not in rows.columns:
            everything = lambda: prepared(landed(session).schema(schema).parquet(landing))
            refresh_pools(rows, everything, output, pool, transform=transform)
            return
        batch.persist()
        try:
            note_files(rows, index, batch_id, pool)
            touched = materialize(rows.select(*cols(pool)).distinct(), "touched")
            files = files_of(index, touched, pool)
            reader = landed(session).schema(schema)
            read = reader.parquet(*files) if files else reader.parquet(landing)
            refresh_pools(rows.drop(LANDED_FILE), lambda: prepared(read), output, pool, transform=transform)
        finally:
            batch.unpersist()

    return (
        landed_stream(spark, landing, schema, names=names, files_per_batch=files_per_batch)
        .select("*", F.col("_metadata.file_path").alias(LANDED_FILE))
        .writeStream.foreachBatch(refresh)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _indexed_from_the_start(spark: SparkSession, index: str, checkpoint: str) -> bool:
    """Whether the index has all files so far: it exists, or nothing was processed yet."""

    def there(path: str) -> bool:
        try:
            spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).limit(0).count()
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return False
            raise
        return True

    return there(index) or not there(f"{checkpoint.rstrip('/')}/offsets")
