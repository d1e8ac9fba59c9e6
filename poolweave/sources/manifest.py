"""Manifests: tables with one row per file, made without reading the data."""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence
from typing import BinaryIO
from urllib.parse import quote

import pandas as pd
from pyarrow import CompressedInputStream, fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from poolweave.functions.columns import unique_header
from poolweave.functions.names import (
    base_name,
    decoded,
    ecb_pool_id,
    esma_pool_id,
    with_name_fields,
)
from poolweave.operators.skew import lookup_join

# Stores whose files the Python side of a task can open by itself.
OPENED_BY_TASKS = ("file", "hdfs", "s3", "s3a", "gs")
OTHER_NAME, EMPTY_FILE = "Name of another form", "Empty file"
HEADER_PIECE = 64 * 1024
COMPRESSIONS = {"gz": "gzip", "bz2": "bz2"}


def list_files(spark: SparkSession, folder: str | list[str], pattern: str = "*") -> DataFrame:
    """``path, name, length`` of the files in a folder; contents are not opened."""
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(folder)
    )
    return listing.select("path", base_name(F.col("path")).alias("name"), "length")


def raw_esma_files(spark: SparkSession, folder: str) -> DataFrame:
    """Loan and collateral files with the parts of their names."""
    files = list_files(spark, folder, "1_*.csv")
    return with_name_fields(files, "name", matching_only=True)


def ecb_files(spark: SparkSession, folder: str) -> DataFrame:
    return list_files(spark, folder, "*.gz").withColumn("pool_id", ecb_pool_id(F.col("name")))


def merged_esma_files(spark: SparkSession, folder: str) -> DataFrame:
    return list_files(spark, folder, "*.csv").withColumn("pool_id", esma_pool_id(F.col("name")))


def unread_files(spark: SparkSession, folder: str, name_pattern: str) -> DataFrame:
    """``path, name, error`` of the files of a folder that no stage reads.

    Names of another form, and files of no bytes: a listing leaves those out, so they are
    what the index of the folder has beyond it.
    """
    listing = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    )
    listed = listing.select("path", base_name(F.col("path")).alias("name"))
    other = listed.filter(~F.col("name").rlike(name_pattern)).withColumn("error", F.lit(OTHER_NAME))
    # The index is on the driver anyhow; only its names travel.
    every = spark.createDataFrame([(p,) for p in listing.inputFiles()], "uri string").select(
        decoded(F.col("uri")).alias("path")
    )
    empty = every.withColumn("__file", base_path(F.col("path"))).join(
        listed.select(base_path(F.col("path")).alias("__file")), "__file", "left_anti"
    )
    empty = empty.select("path", base_name(F.col("path")).alias("name"), F.lit(EMPTY_FILE).alias("error"))
    return other.unionByName(empty)


def with_headers(files: DataFrame, paths: str | Sequence[str], pattern: str = "*") -> DataFrame:
    """Add the raw ``header_line`` of each file; null for a file without one.

    Tasks open the files and read no further than the first line, where the store is
    one that tasks can open; otherwise the files' first blocks are scanned, found at
    ``paths`` (a folder, or a list) by ``pattern``.
    """
    schemes = files.select(scheme_of(F.col("path")).alias("scheme")).distinct().collect()
    can_open = all(row.scheme in OPENED_BY_TASKS for row in schemes)
    headers = (first_lines(files) if can_open else scanned_first_lines(files, paths, pattern)).select(
        base_path(F.col("path")).alias("__path"),
        F.regexp_replace("header_line", "^\\uFEFF|\\r$", "").alias("header_line"),
    )
    keyed = files.withColumn("__file", base_path(F.col("path")))
    return keyed.join(headers, keyed["__file"] == headers["__path"], "left").drop(
        "__file", "__path"
    )


def _scheme(path: str) -> str:
    return path.split(":", 1)[0] if ":" in path.split("/", 1)[0] else "file"


def first_lines(files: DataFrame) -> DataFrame:
    """``path, header_line`` by opening each file of the manifest."""
    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lines = [_first_line(path) for path in batch["path"]]
            yield pd.DataFrame({"path": batch["path"], "header_line": lines})

    spread = files.select("path").repartition(tasks, "path")
    return spread.mapInPandas(read, "path string, header_line string")


def open_file(path: str) -> BinaryIO:
    """A file as a stream of its stored bytes, opened by a task."""
    scheme, place = _scheme(path), path.split(":", 1)[-1]
    if scheme == "file":
        store, name = fs.LocalFileSystem(), "/" + place.lstrip("/")
    else:
        uri = f"{scheme.replace('s3a', 's3')}:{quote(place)}"
        store, name = fs.FileSystem.from_uri(uri)
    return store.open_input_stream(name, compression=None)


def _first_line(path: str) -> str | None:
    """The first line of a file, of its text if it is compressed."""
    line = b""
    with open_file(path) as stored:
        compressed = path.rsplit(".", 1)[-1] in COMPRESSIONS
        stream = CompressedInputStream(stored, COMPRESSIONS[path.rsplit(".", 1)[-1]]) if compressed else stored
        while b"\n" not in line and (piece := stream.read(HEADER_PIECE)):
            line += piece
    return line.split(b"\n", 1)[0].decode("utf-8", "replace") or None


def scheme_of(path: Column) -> Column:
    """The scheme of a path; of one without, the local one."""
    found = F.regexp_extract(path, "^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    return F.when(found == "", F.lit("file")).otherwise(found)


def scanned_first_lines(
    files: DataFrame, paths: str | Sequence[str], pattern: str = "*"
) -> DataFrame:
    """``path, header_line`` by scanning the first block of each file as text.

    The place of the first line is found without carrying the lines, which would have
    to be sorted for it; then those lines are picked from the same scan.
    """
    lines = (
        files.sparkSession.read.option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .text(paths if isinstance(paths, str) else list(paths))
        .select(
            "value",
            F.col("_metadata.file_path").alias("__uri"),
            F.col("_metadata.file_block_start").alias("__block"),
            F.monotonically_increasing_id().alias("__place"),
        )
        .filter(F.col("__block") == 0)
    )
    firsts = lines.groupBy("__uri").agg(F.min("__place").alias("__place"))
    headers = lookup_join(lines, firsts, ["__uri", "__place"], "left_semi", null_safe=False)
    return headers.select(
        decoded(F.col("__uri")).alias("path"), F.col("value").alias("header_line")
    )


def base_path(path: Column) -> Column:
    """A path without the scheme, which listings and scans write differently."""
    return F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "/")


def header_names(line: str) -> list[str]:
    return next(csv.reader([line]))


def parse_header(line: str) -> list[str]:
    """Column names of one header line; repeated names are numbered."""
    return unique_header(header_names(line))
