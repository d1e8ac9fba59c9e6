"""CSV scans: every value as text.

A scan over files with different headers would put values under wrong names. Files of
one known header are read under it (:func:`read_csv`); files of any headers in one scan
that picks columns by position (:mod:`poolweave.sources.one_scan`).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from poolweave.functions.columns import (
    cols,
    require_distinct_by_case,
    require_unreserved,
)
from poolweave.functions.names import decoded
from poolweave.functions.nulls import EMPTY_ONLY, RAW_FILE_NULL_TOKENS, apply_null_tokens
from poolweave.session import materialize
from poolweave.sources.manifest import with_headers
from poolweave.sources.one_scan import PIPELINE_COLUMNS, POSITION, Place, scan_once


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str],
    *,
    null_tokens: Iterable[str] = RAW_FILE_NULL_TOKENS,
    positions: bool = False,
    check_header: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """Files of one known header as text columns.

    A file with another header fails the job instead of shifting its columns, unless
    the check is off (needed for headers that repeat a name, which differ from the
    numbered ``columns``). ``multi_line`` allows line ends inside quotes, at the price
    of one task per file. With
    ``positions`` the columns ``file_name, block_start, row_place`` give the storage
    order; they are taken in the scan, before any shuffle.
    """
    case_sensitive = spark.conf.get("spark.sql.caseSensitive") == "true"
    require_distinct_by_case(columns, case_sensitive)
    if positions:
        require_unreserved(columns, (*POSITION, *PIPELINE_COLUMNS))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    scan = (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .option("enforceSchema", not check_header)
        .csv(paths if isinstance(paths, str) else list(paths))
    )
    place = {
        "file_name": decoded(F.col("_metadata.file_name")),
        "block_start": F.col("_metadata.file_block_start"),
        "row_place": F.monotonically_increasing_id(),
    }
    scan = scan.select(*cols(columns), *(c.alias(n) for n, c in place.items() if positions))
    tokens = [t for t in null_tokens if t not in EMPTY_ONLY]  # empty text is null already
    return apply_null_tokens(scan, tokens, columns)


def scan_manifest(files: DataFrame, place: Place | None = None, **options) -> DataFrame:
    """Read headers and data of the files in a manifest.

    ``place`` says where they lie; without it their paths are listed first, which a
    folder of very many files should not need. ``options`` are those of
    :func:`poolweave.sources.one_scan.scan_once`.
    """
    if place is None:
        place = Place([row.path for row in files.select("path").collect()])
    return scan_once(place, materialize(with_headers(files, place.paths, place.pattern), "manifest"), **options)
