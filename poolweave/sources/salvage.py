"""Gzip files the ordinary reader refuses, and what can still be read of them.

Files are probed one per row of the manifest; damaged ones go to a quarantine table
with the reason. Their readable part is recovered line by line and flagged: bytes
after a damaged place may be wrong, so nothing is trusted silently.
"""

from __future__ import annotations

import io
import zlib
from collections import deque
from collections.abc import Callable, Iterator, Sequence
from itertools import islice
from typing import BinaryIO

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poolweave.functions.columns import cols
from poolweave.functions.names import base_name
from poolweave.functions.nulls import RAW_FILE_NULL_TOKENS, apply_null_tokens
from poolweave.sources.manifest import OPENED_BY_TASKS, open_file, scheme_of

# Fixed values of the gzip format.
GZIP_MAGIC = b"\x1f\x8b"
GZIP_HEADER_BYTES = 10

PIECE = 1 << 20
LINES_PER_BATCH = 10_000
BYTE_ORDER_MARK = "\ufeff"
NOT_GZIP = "Not a gzipped file"
WHOLE_TEXT = (None, NOT_GZIP, "CRC check failed", "Trailing data")


class _Bytes:
    """Bytes of a file read ahead as needed, a piece at a time."""

    def __init__(self, source: BinaryIO):
        self.source = source
        self.ahead = b""

    def has(self, n: int) -> bool:
        """Whether so many bytes are left; they are then in ``ahead``."""
        while len(self.ahead) < n and (piece := self.source.read(PIECE)):
            self.ahead += piece
        return len(self.ahead) >= n

    def take(self, n: int) -> bytes:
        self.has(n)
        taken, self.ahead = self.ahead[:n], self.ahead[n:]
        return taken

    def skip_text(self) -> None:
        """Skip a text and the zero byte behind it."""
        while self.has(1) and b"\0" not in self.ahead:
            self.ahead = b""
        self.ahead = self.ahead.partition(b"\0")[2]


def inflated(content: bytes | BinaryIO, errors: list[str]) -> Iterator[bytes]:
    """The text of all members of a gzip file, piece by piece, as far as it goes.

    A piece of the file and a piece of text are all that is held, whatever the file's
    size. Problems are appended to ``errors``. A file that does not start like gzip is
    taken as one bare deflate stream behind a header of the usual length.
    """
    source = _Bytes(io.BytesIO(content) if isinstance(content, bytes) else content)
    first = True
    while source.has(1):
        is_member = source.has(2) and source.ahead.startswith(GZIP_MAGIC)
        if not is_member:
            errors.append(NOT_GZIP if first else "Trailing data")
            if not first:
                return
        first = False
        header = source.take(GZIP_HEADER_BYTES)
        if is_member:
            _skip_optional_fields(source, header)
        decoder = zlib.decompressobj(-zlib.MAX_WBITS)
        check = size = 0
        while not decoder.eof and (decoder.unconsumed_tail or source.has(1)):
            piece = decoder.unconsumed_tail or source.take(PIECE)
            try:
                text = decoder.decompress(piece, PIECE)
            except zlib.error as problem:
                errors.append(str(problem))
                return
            check, size = zlib.crc32(text, check), size + len(text)
            yield text
        if not decoder.eof:
            errors.append("Compressed file ended before the end-of-stream marker")
            return
        if not is_member:
            return
        source.ahead = decoder.unused_data + source.ahead
        if source.take(4) != check.to_bytes(4, "little"):
            errors.append("CRC check failed")
            source.take(4)
        elif source.take(4) != (size % (1 << 32)).to_bytes(4, "little"):
            errors.append("Incorrect length of data produced")
        while source.has(1) and source.ahead.startswith(b"\0"):  # padding between members
            source.ahead = source.ahead.lstrip(b"\0")


def text_lines(content: bytes | BinaryIO, errors: list[str]) -> Iterator[str]:
    """Lines of a gzip file; a last line that damage may have cut is left out."""
    rest = b""
    for text in inflated(content, errors):
        *whole, rest = (rest + text).split(b"\n")
        for line in whole:
            yield line.decode("utf-8", "replace").removesuffix("\r")
    if rest and all(e in WHOLE_TEXT for e in errors):
        yield rest.decode("utf-8", "replace").removesuffix("\r")


def _skip_optional_fields(source: _Bytes, header: bytes) -> None:
    flags = header[3] if len(header) > 3 else 0
    if flags & 4:
        source.take(int.from_bytes(source.take(2), "little"))
    for field in (8, 16):
        if flags & field:
            source.skip_text()
    if flags & 2:
        source.take(2)


def _per_file(
    spark: SparkSession,
    paths: str | Sequence[str],
    work: Callable[[str, BinaryIO], Iterator[pd.DataFrame]],
    schema: str,
    pattern: str = "*",
) -> DataFrame:
    """``work`` on each file. Tasks open the files and read them as streams; where the
    store is one that only Spark opens, a file's content comes as one value instead."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(paths if isinstance(paths, str) else list(paths))
    )
    schemes = files.select(scheme_of(F.col("path")).alias("scheme")).distinct().collect()
    streamed = all(row.scheme in OPENED_BY_TASKS for row in schemes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                if streamed:
                    with open_file(row.path) as stream:
                        yield from work(row.path, stream)
                else:
                    yield from work(row.path, io.BytesIO(row.content))

    if not streamed:
        return files.select("path", "content").mapInPandas(run, schema)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.select("path").repartition(tasks, "path").mapInPandas(run, schema)


def probe_gzip(
    spark: SparkSession, paths: str | Sequence[str], pattern: str = "*"
) -> DataFrame:
    """``path, header_line, error`` per file: one read finds the header and damage.

    ``error`` is null for a sound file, ``header_line`` for one without content.
    """

    def probe(path: str, stream: BinaryIO) -> Iterator[pd.DataFrame]:
        errors: list[str] = []
        lines = text_lines(stream, errors)
        header = next(lines, "").removeprefix(BYTE_ORDER_MARK)
        deque(lines, maxlen=0)  # read to the end without keeping it
        row = [path, header or None, errors[0] if errors else None]
        yield pd.DataFrame([row], columns=["path", "header_line", "error"])

    return _per_file(
        spark, paths, probe, "path string, header_line string, error string", pattern
    )


def recovered_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``path, line_number, line`` of the readable part, cut at the last line end."""

    def lines(path: str, stream: BinaryIO) -> Iterator[pd.DataFrame]:
        numbered = enumerate(text_lines(stream, []))
        while piece := list(islice(numbered, LINES_PER_BATCH)):
            table = pd.DataFrame(piece, columns=["line_number", "line"])
            yield table.assign(path=path)[["path", "line_number", "line"]]

    return _per_file(spark, paths, lines, "path string, line_number long, line string")


def salvage(
    spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Rows of damaged files of one header, with ``file_name`` and ``salvaged``."""
    rows = recovered_lines(spark, paths).filter(
        (F.col("line_number") > 0) & (F.col("line") != "")
    )
    fields = ", ".join(f"`{c.replace('`', '``')}` string" for c in columns)
    parsed = rows.select(
        F.from_csv("line", fields, {"quote": '"', "escape": '"'}).alias("__row"),
        base_name(F.col("path")).alias("file_name"),
        F.col("line_number").alias("row_place"),
    ).select(
        "__row.*", "file_name", F.lit(0).cast("long").alias("block_start"), "row_place"
    )
    cleaned = apply_null_tokens(parsed, RAW_FILE_NULL_TOKENS, columns)
    return cleaned.select(
        *cols(columns), "file_name", "block_start", "row_place", F.lit(True).alias("salvaged")
    )
