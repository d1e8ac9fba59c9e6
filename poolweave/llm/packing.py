"""Packing by lexical retrieval: a window is filled with a document's neighbours.

Documents are encoded and cut at the window size; full windows are done. What is left
of each document is an item. Items are dealt into shards by a hash of their words, so
that related ones meet, and every shard has a BM25 inverted index with the statistics
of all items. The next unused item of a shard seeds a window; its best unused
neighbours fill it, and the last one is cut to fit: what is cut off seeds the next
window. Only the last window of a shard has room left.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from poolweave.llm import tokens
from poolweave.llm.common import mix, summed_counts, text_blocks, text_bytes, whole_text
from poolweave.session import materialize

WINDOW = 2048
END_ID = 1
SHARD_ITEMS = 2048  # items of an index; a bound on memory, not on the corpus
QUERY_TERMS = 12  # of a seed's terms, those with the highest weight
NEIGHBOURS = 64  # ranked neighbours of a seed, before the next item becomes a seed
K1, B = 1.2, 0.75


def _binary(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def _encoded(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Full windows (with a sequence_id) and items (with ids and terms) of all rows."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokens.word_ids(tokenizer)
        sequence = TaskContext.get().partitionId() << 33 | 1
        for block in text_blocks(batches, "text"):
            ids, first, terms, first_word = words.encode_with_terms(block.column("text"))
            n = block.num_rows
            owner = np.repeat(np.arange(n, dtype=np.int64), np.diff(first_word))
            keys, times = np.unique(owner << 16 | terms, return_counts=True)
            cuts = np.searchsorted(keys, np.arange(n + 1) << 16)
            keys, times = keys.astype(np.uint16), np.minimum(times, 255).astype(np.uint8)
            row, start, length, crc, number, kept, term, sign = [], [], [], [], [], [], [], []
            for k in range(n):
                own = np.append(ids[first[k] : first[k + 1]], END_ID).astype("<u2")
                for begin in range(0, len(own), WINDOW):
                    piece = own[begin : begin + WINDOW]
                    whole = len(piece) == WINDOW
                    row.append(k)
                    start.append(begin)
                    length.append(len(piece))
                    crc.append(zlib.crc32(piece.astype("<u4").tobytes()) if whole else None)
                    number.append(sequence if whole else None)
                    kept.append(None if whole else piece.tobytes())
                    if whole:
                        sequence += 2
                        term.append(None)
                        sign.append(None)
                    else:
                        some = slice(cuts[k], cuts[k + 1])
                        term.append(keys[some].tobytes() + times[some].tobytes())
                        hashed = mix(keys[some].astype(np.uint64))
                        sign.append(int(hashed.min()) >> 1 if len(hashed) else 0)
            total = np.diff(first) + 1
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": block.column("doc_id").take(pa.array(row, pa.int64())),
                    "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64()),
                    "doc_tokens": pa.array(total[row] if row else [], pa.int64()),
                    "sequence_id": pa.array(number, pa.int64()),
                    "ids": _binary(kept),
                    "terms": _binary(term),
                    "near": pa.array(sign, pa.int64()),
                }
            )

    schema = T.StructType(
        [T.StructField("doc_id", docs.schema["doc_id"].dataType)]
        + [T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id")]
        + [T.StructField(c, T.BinaryType()) for c in ("ids", "terms")]
        + [T.StructField("near", T.LongType())]
    )
    return docs.mapInArrow(encode, schema)


def _term_counts(values: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Item, term and times of all terms of a column of items."""
    data, borders = text_bytes(values)
    n = np.diff(borders) // 3
    item = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(item)) - np.repeat(np.cumsum(n) - n, n)
    begin = np.repeat(borders[:-1], n)
    low, high = data[begin + 2 * place], data[begin + 2 * place + 1]
    term = low.astype(np.int64) | high.astype(np.int64) << 8
    return item, term, data[begin + 2 * np.repeat(n, n) + place].astype(float)


class Index:
    """BM25 over the items of a shard; statistics come from all items."""

    def __init__(self, terms: pa.Array, idf: np.ndarray, mean_terms: float):
        item, term, times = _term_counts(terms)
        self.n = len(terms)
        lengths = np.bincount(item, times, self.n)
        scale = K1 * (1 - B + B * lengths[item] / max(mean_terms, 1e-9))
        weight = idf[term] * times * (K1 + 1) / (times + scale)
        order = np.argsort(term, kind="stable")
        self.items, self.weights = item[order], weight[order]
        sorted_terms = term[order]
        self.first = np.searchsorted(sorted_terms, term, "left")
        self.last = np.searchsorted(sorted_terms, term, "right")
        # Of each item the terms with the highest weight that another item has too.
        shared = np.flatnonzero(self.last - self.first > 1)
        best = shared[np.lexsort((-weight[shared], item[shared]))]
        begin = np.searchsorted(item[best], np.arange(self.n + 1))
        self.query = [best[a : min(b, a + QUERY_TERMS)] for a, b in zip(begin, begin[1:])]

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused items that share a term with the seed, the best ones first."""
        spans = [slice(self.first[q], self.last[q]) for q in self.query[seed]]
        if not spans:
            return np.zeros(0, np.int64)
        items = np.concatenate([self.items[s] for s in spans])
        weights = np.concatenate([self.weights[s] for s in spans])
        score = np.bincount(items, weights, self.n)
        score[~unused] = 0
        found = np.flatnonzero(score)
        return found[np.argsort(-score[found], kind="stable")][:NEIGHBOURS]


def fill(lengths: np.ndarray, index: Index) -> list[tuple[int, int, int, int, int]]:
    """Pieces (item, start in it, length, window, offset) that hold all items once."""
    unused = np.ones(len(lengths), bool)
    done = np.zeros(len(lengths), np.int64)
    pieces = []
    window, offset, turn = 0, 0, 0
    seed = -1

    def place(item: int) -> None:
        nonlocal window, offset
        size = int(min(lengths[item] - done[item], WINDOW - offset))
        pieces.append((item, int(done[item]), size, window, offset))
        done[item] += size
        unused[item] = False
        offset += size

    while True:
        if seed < 0:
            while turn < len(lengths) and not unused[turn]:
                turn += 1
            if turn == len(lengths):
                return pieces
            seed = turn
        place(seed)
        over = []
        if offset < WINDOW:
            for item in index.neighbours(seed, unused):
                if lengths[item] <= WINDOW - offset:
                    place(item)
                else:
                    over.append(item)
                if offset == WINDOW:
                    break
        last = seed
        if offset < WINDOW and over:
            last = over[0]
            place(last)  # cut to fit
        if offset == WINDOW:
            window, offset = window + 1, 0
        seed = last if done[last] < lengths[last] else -1


def pack(docs: DataFrame, tokenizer: str = tokens.TOKENIZER) -> DataFrame:
    """All rows of ``docs`` (doc_id, text) as pieces of sequences of at most 2048 ids.

    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. A null
    text is the empty one: the end id alone. Rows that repeat, and rows without doc_id,
    are packed like any other; other columns are ignored. Texts of any length are packed
    whole, in as many pieces as they need; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    encoded = materialize(_encoded(docs.select("doc_id", whole_text().alias("text")), tokenizer), "encoded")
    items = encoded.filter("ids IS NOT NULL")
    n_items, sum_terms = items.agg(F.count(F.lit(1)), F.sum(F.octet_length("terms") / 3)).first()
    counts = summed_counts(items.select("terms"), 16, lambda block: _term_counts(block.column("terms"))[1], "terms")
    idf = spark.sparkContext.broadcast(np.log1p((n_items - counts + 0.5) / (counts + 0.5)))
    mean_terms = (sum_terms or 0) / max(n_items, 1)

    def fill_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 33
        for batch in batches:
            for k in range(0, batch.num_rows, SHARD_ITEMS):
                shard = batch.slice(k, SHARD_ITEMS)
                lengths = np.asarray(shard.column("length"))
                data, borders = text_bytes(shard.column("ids"))
                ids = np.frombuffer(data.tobytes(), "<u2").astype("<u4")
                pieces = np.array(fill(lengths, Index(shard.column("terms"), idf.value, mean_terms)))
                item, start, length, window, offset = pieces.T
                at = borders[item] // 2 + start
                crc = [zlib.crc32(ids[a : a + n].tobytes()) for a, n in zip(at, length)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": shard.column("doc_id").take(pa.array(item)),
                        "start": np.asarray(shard.column("start"))[item] + start,
                        "length": length,
                        "ids_crc32": pa.array(crc, pa.int64()),
                        "doc_tokens": np.asarray(shard.column("doc_tokens"))[item],
                        "sequence_id": sequence + 2 * window,
                        "offset": offset,
                    }
                )
                sequence += 2 * (int(window.max()) + 1)

    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id"]
    windows = encoded.filter("ids IS NULL").select(*columns, F.lit(0).cast("long").alias("offset"))
    schema = T.StructType([f for f in windows.schema.fields])
    near = items.repartitionByRange("near", "doc_id", "start").sortWithinPartitions("near", "doc_id", "start")
    packed = near.select("doc_id", "start", "length", "doc_tokens", "ids", "terms").mapInArrow(fill_shards, schema)
    return windows.unionAll(packed)
