"""Columns, batches and word hashes that several operators share.

Texts reach Python tasks as Arrow batches. :func:`text_blocks` cuts a batch into
blocks of a megabyte, so that the arrays made from a block stay small however
many rows a batch has; a text longer than a block is a block of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 1 << 20

#: Space, tab, line feed, vertical tab, form feed, carriage return.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, a missing one as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def remainder(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; -1 without an id."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % divisor, F.lit(-1))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of an array end to end, and each text's borders."""
    texts = texts.cast(pa.large_binary())
    borders = np.frombuffer(texts.buffers()[1], np.int64)
    borders = borders[texts.offset : texts.offset + len(texts) + 1]
    if texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), borders - borders[0]
    data = np.frombuffer(texts.buffers()[2], np.uint8)[borders[0] : borders[-1]]
    return data, borders - borders[0]


@contextmanager
def rows_per_batch(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs inside send Python tasks so many rows at once: for rows of many kilobytes."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def text_blocks(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` text bytes, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, borders = text_bytes(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(borders, borders[first] + limit, "right")) - 1
            last = max(first + 1, last)
            yield batch.slice(first, last - first)
            first = last


def summed_counts(
    frame: DataFrame, bits: int, places: Callable[[pa.RecordBatch], np.ndarray], column: str
) -> np.ndarray:
    """How often each of ``2**bits`` places occurs in what ``places`` gives for a block.

    ``column`` is the column by which blocks are cut. The counts of a task leave it as a
    fixed number of rows, one for each chunk of places; chunks are added up in tasks of
    their own. Few tasks count, since each one sends all its counts.
    """
    size = 1 << min(bits, 16)
    chunks = (1 << bits) // size

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, np.uint32)
        for block in text_blocks(batches, column):
            place, n = np.unique(places(block), return_counts=True)
            counts[place] += n.astype(np.uint32)
        for k in range(chunks):
            part = counts[k * size : (k + 1) * size]
            if part.any():
                yield pa.RecordBatch.from_pydict({"chunk": pa.array([k], pa.int32()), "counts": [part.tobytes()]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, data in zip(batch.column("chunk").to_pylist(), batch.column("counts")):
                total = sums.setdefault(chunk, np.zeros(size, np.int64))
                total += np.frombuffer(data.as_buffer(), np.uint32)
        for chunk, total in sums.items():
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk], pa.int32()), "counts": [total.tobytes()]})

    schema = "chunk int, counts binary"
    tasks = 2 * frame.sparkSession.sparkContext.defaultParallelism
    parts = frame.coalesce(tasks).mapInArrow(count, schema)
    out = np.zeros(1 << bits, np.int64)
    for row in parts.repartition(chunks, "chunk").mapInArrow(add, schema).collect():  # 2**bits numbers
        out[row["chunk"] * size : (row["chunk"] + 1) * size] = np.frombuffer(row["counts"], np.int64)
    return out


def random_odd(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random odd 64-bit numbers (splitmix64)."""
    with np.errstate(over="ignore"):
        x = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return mix(x + np.uint64(seed)) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_KEYS = random_odd(256, 17)


def position_keys(n: int) -> np.ndarray:
    """The keys of the positions of a word."""
    return _KEYS[:n] if n <= len(_KEYS) else random_odd(n, 17)


@dataclass
class Words:
    """The words of a block: hashes, byte ranges, and each text's first word."""

    hashes: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    first: np.ndarray  # one more than texts


def hashed_words(data: np.ndarray, borders: np.ndarray) -> Words:
    """Words between ASCII white space, hashed with A-Z in lower case.

    The hash sums byte times key over the positions of a word (64 bits).
    """
    inside = ~IS_SPACE[data]
    before = np.empty(len(data), bool)
    before[1:] = inside[:-1]
    if len(data):
        before[borders[:-1][borders[:-1] < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    if not len(starts):
        empty = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), empty, empty, np.zeros(len(borders), np.int64))
    ordinal = np.cumsum(inside)
    first_byte = ordinal[starts] - 1
    lengths = np.diff(np.append(first_byte, ordinal[-1]))
    place = np.arange(ordinal[-1]) - np.repeat(first_byte, lengths)
    values = LOWER[data[inside]].astype(np.uint64) + np.uint64(1)
    values *= position_keys(int(lengths.max()))[place]
    hashes = mix(np.add.reduceat(values, first_byte) + lengths.astype(np.uint64))
    return Words(hashes, starts, lengths, np.searchsorted(starts, borders))


def shingle_hashes(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``size``-word shingles and each text's first one.

    A text with fewer words has its whole sequence as its only shingle; a text
    without words has none.
    """
    keys = random_odd(size, 99)
    n = len(words.hashes)
    counts = np.diff(words.first)
    rolled = np.zeros(max(0, n - size + 1), np.uint64)
    for k in range(size):
        rolled += words.hashes[k : k + len(rolled)] * keys[k]
    rolled = mix(rolled)
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    first = np.append(0, np.cumsum(made))
    out = np.empty(first[-1], np.uint64)
    long = counts >= size
    source = ranges(words.first[:-1][long], made[long])
    out[ranges(first[:-1][long], made[long])] = rolled[source]
    for text in np.flatnonzero((counts > 0) & ~long):
        own = words.hashes[words.first[text] : words.first[text + 1]]
        out[first[text]] = mix((own * keys[: len(own)]).sum(keepdims=True) + np.uint64(len(own)))[0]
    return out, first


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of all ranges, one after the other."""
    if not len(starts):
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)
