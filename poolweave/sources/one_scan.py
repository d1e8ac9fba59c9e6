"""One scan over files of any number of headers.

A scan by header needs a scan, a union and a place in the plan for each of them. Here
all files are read at once as numbered fields. A small table says for each header which
field holds which column; rows find their header through their file and pick every
column from its field. The plan grows with the number of columns only, and no list of
paths passes through the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from poolweave.functions.columns import require_distinct_by_case, require_unreserved
from poolweave.functions.names import decoded
from poolweave.functions.nulls import EMPTY_ONLY, FEW_COLUMNS, RAW_FILE_NULL_TOKENS, null_if_token
from poolweave.operators.skew import lookup_join
from poolweave.session import materialize
from poolweave.sources.manifest import base_path, parse_header

POSITION = ("file_name", "block_start", "row_place")
# Columns the stages add to scanned rows, besides the position.
PIPELINE_COLUMNS = (
    "asset_type",
    "identifier",
    "date",
    "ue_name",
    "merged_name",
    "pool_id",
    "bucket",
    "country",
    "salvaged",
)
VALUES, NAMES = "__values", "__header_names"

_FILE, _URI, _HEADER = "__file", "__uri", "__header_id"


@dataclass(frozen=True)
class Place:
    """Where a scan finds its files: folders or paths, and the names it takes of them."""

    paths: str | Sequence[str]
    pattern: str = "*"


def header_table(files: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    """``header_id, header_line, raw_names, names`` of every different header.

    ``names`` are the columns under their new names. Headers are parsed in tasks.
    """
    new = dict(renames or {})

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = batch["header_line"].map(parse_header)
            yield batch.assign(raw_names=raw, names=raw.map(lambda names: [new.get(n, n) for n in names]))

    distinct = files.filter(F.col("header_line").isNotNull()).select("header_line").distinct()
    numbered = distinct.withColumn("header_id", F.row_number().over(Window.orderBy("header_line")))
    return numbered.select("header_id", "header_line").mapInPandas(
        parse, "header_id int, header_line string, raw_names array<string>, names array<string>"
    )


def column_names(headers: DataFrame, names: str = "names") -> list[str]:
    """All columns of the headers, in the order in which they first occur."""
    placed = headers.select("header_id", F.posexplode(names).alias("place", "name"))
    firsts = placed.groupBy("name").agg(F.min(F.struct("header_id", "place")).alias("first"))
    return [r["name"] for r in firsts.orderBy("first").collect()]


def field_rows(
    place: Place,
    files: DataFrame,
    headers: DataFrame,
    *,
    null_tokens: Iterable[str] = RAW_FILE_NULL_TOKENS,
    multi_line: bool = False,
) -> DataFrame:
    """All rows of the listed files: position, header_id and their fields as an array.

    ``files`` has ``path`` and ``header_line``; other files at the place are left out.
    Texts that stand for a missing value are null.
    """
    spark = files.sparkSession
    width = headers.agg(F.max(F.size("names"))).first()[0] or 1
    fields = [f"_{k}" for k in range(width)]
    scan = (
        spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in fields]))
        .option("header", True)
        .option("enforceSchema", True)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .option("pathGlobFilter", place.pattern)
        .option("recursiveFileLookup", True)
        .csv(place.paths if isinstance(place.paths, str) else list(place.paths))
    )
    tokens = [t for t in null_tokens if t not in EMPTY_ONLY]  # empty text is null already
    values = F.array(*fields)
    if tokens and width <= FEW_COLUMNS:  # compiled, which a function over an array is not
        values = F.array(*(null_if_token(F.col(c), tokens) for c in fields))
    elif tokens:
        values = F.transform(values, lambda v: null_if_token(v, tokens))
    rows = scan.select(
        F.col("_metadata.file_path").alias(_URI),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_place"),
        values.alias(VALUES),
    )
    listed = files.join(headers.select("header_line", "header_id"), "header_line").select(
        base_path(F.col("path")).alias(_FILE), F.col("header_id").alias(_HEADER)
    )
    # Escaped paths are taken apart once for a file, not for each of its rows.
    known = listed.join(_escaped_paths(spark, place), _FILE).select(_URI, "file_name", _HEADER)
    found = lookup_join(rows, materialize(known, "listed"), [_URI], "inner", null_safe=False)
    return found.select("file_name", "block_start", "row_place", VALUES, F.col(_HEADER).alias("header_id"))


def _escaped_paths(spark: SparkSession, place: Place) -> DataFrame:
    """Each file of a place: its path as scans write it, the plain path and the name."""
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", place.pattern)
        .option("recursiveFileLookup", True)
        .load(place.paths if isinstance(place.paths, str) else list(place.paths))
    )
    uri = F.col("_metadata.file_path")
    return listing.select(
        uri.alias(_URI), base_path(decoded(uri)).alias(_FILE), decoded(F.col("_metadata.file_name")).alias("file_name")
    )


def picked(values: Column, places: Column) -> Column:
    """The fields at these places; null for a place below 0 or beyond the row."""
    return F.transform(places, lambda p: F.get(values, p.cast("int")))


def place_of_each(names: Sequence[str], own: Column) -> Column:
    """For every name its place in the array ``own``, or -1."""
    return F.transform(F.array(*map(F.lit, names)), lambda n: F.array_position(own, n) - 1)


def scan_once(
    place: Place,
    files: DataFrame,
    *,
    renames: Mapping[str, str] | None = None,
    derive: Callable[[DataFrame, Callable[[str], Column]], DataFrame] | None = None,
    null_tokens: Iterable[str] = RAW_FILE_NULL_TOKENS,
    positions: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """All listed files under the union of their columns, every value as text.

    ``files`` is a manifest with ``path`` and ``header_line``. ``renames`` gives columns
    new names, none of which may occur twice in a header. ``derive`` adds columns: it
    gets the rows and a function that tells whether a row's header has a column.
    """
    spark = files.sparkSession
    headers = materialize(header_table(files, renames), "headers")
    clash = headers.filter(F.size("names") > F.size(F.array_distinct("names"))).first()
    if clash is not None:
        new = [n for n in clash["names"] if clash["names"].count(n) > 1]
        origins = {t: [r for r, n in zip(clash["raw_names"], clash["names"]) if n == t] for t in new}
        raise ValueError(f"several columns would get one field code: {origins}")
    names = column_names(headers)
    if not names:
        raise ValueError("no file with a header to scan")
    require_distinct_by_case(names, spark.conf.get("spark.sql.caseSensitive") == "true")
    if positions:
        require_unreserved(column_names(headers, "raw_names"), (*POSITION, *PIPELINE_COLUMNS))
    rows = field_rows(place, files, headers, null_tokens=null_tokens, multi_line=multi_line)
    placed = materialize(
        headers.select("header_id", F.col("names").alias(NAMES), place_of_each(names, F.col("names")).alias("__places")),
        "header-places",
    )
    found = lookup_join(rows, placed, ["header_id"], "inner", null_safe=False).select(
        *POSITION, NAMES, picked(F.col(VALUES), F.col("__places")).alias(VALUES)
    )
    kept = [*POSITION, NAMES] if positions else [NAMES]
    out = found.select(*(F.col(VALUES)[k].alias(n) for k, n in enumerate(names)), *kept)
    if derive is not None:
        out = derive(out, lambda name: F.array_contains(NAMES, name))
    return out.drop(NAMES)
