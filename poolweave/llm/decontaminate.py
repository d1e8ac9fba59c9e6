"""Benchmark decontamination by latent semantic retrieval.

Benchmark items become passages. Passages of similar length share latent spaces, about
192 in each; a space's TF-IDF matrix is factored by a distributed randomised SVD
(subspace iteration, one Spark job a step) of full rank, so that no passage loses weight
to the others. Documents are read as overlapping windows of words, windows go into each
space and meet its passages by cosine. Each candidate is then checked for its longest common subsequence
with the passage, and a looser, paraphrased one also for the passage's answer: its
rarest words. Document frequencies are counted over all documents.

A short item says too little for a cosine amid other words. Items of fewer than
:data:`EXACT_WORDS` words are found as whole word sequences as well, those below
:data:`LEAST_WORDS` in that way only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from poolweave.llm.common import (
    Words,
    hashed_words,
    mix,
    random_odd,
    ranges,
    summed_counts,
    text_blocks,
    text_bytes,
    whole_text,
)
from poolweave.session import materialize

FREQUENCY_BITS = 20  # document frequencies by word hash: a million, whatever the corpus
PASSAGE_WORDS = 64  # longer items are several passages
LEAST_WORDS = 8  # shorter items are matched as whole word sequences only
EXACT_WORDS = 16  # and so are those below this, besides the search
MAX_SHORT = 50_000  # short items held by a task at once; more are matched in several passes
MAX_PASSAGES = 2000  # held by a task at once; more are searched in several passes
RANK = 192  # about so many passages share a latent space, which has all their directions
STEPS = 3
GRID = 8  # windows begin at every eighth word
SCALES = (2, 4, 8)  # windows of so many grid steps
LEAST_COSINE = 0.4
COPY = 0.8  # share of a passage's words in common order, for a copy
PARAPHRASE = 0.6  # likewise if the answer is there as well
ANSWER_WORDS, ANSWER_SHARE = 5, 0.8
SLACK = 1.25  # a copy may be so much longer than its passage


@dataclass
class Passages:
    """Passages that are searched with one window length, and their latent space."""

    item: list
    words: list[np.ndarray]
    rows: np.ndarray  # by bucket: a row of vectors, 0 for a word of no passage
    vectors: np.ndarray  # right singular vectors times idf; row 0 is 0
    latent: np.ndarray  # unit vectors of the passages
    steps: int  # of their windows
    answers: list[set]


@dataclass
class Short:
    """Short items by number of words: sorted hashes of their word sequences."""

    hashes: dict[int, np.ndarray]
    owners: dict[int, list[list[int]]]  # items of each hash
    words: list[np.ndarray]
    item: list


def _sequence_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of every ``size`` words in a row."""
    keys = random_odd(size, 99)
    rolled = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
    for k in range(size):
        rolled += hashes[k : k + len(rolled)] * keys[k]
    return mix(rolled)


def _short_items(rows: list) -> Short:
    """From (item_id, words)."""
    words = [np.frombuffer(r["words"], np.uint64) for r in rows]
    by_size: dict[int, dict[int, list[int]]] = {}
    for k, w in enumerate(words):
        by_size.setdefault(len(w), {}).setdefault(int(_sequence_hashes(w, len(w))[0]), []).append(k)
    hashes = {n: np.array(sorted(found), np.uint64) for n, found in by_size.items()}
    owners = {n: [by_size[n][int(h)] for h in hashes[n]] for n in hashes}
    return Short(hashes, owners, words, [r["item_id"] for r in rows])


def _exact_matches(words: Words, short: Short) -> list[tuple]:
    """(row, item, first word) of the first place of each short item in each text."""
    found = {}
    for size, known in short.hashes.items():
        rolled = _sequence_hashes(words.hashes, size)
        place = np.minimum(np.searchsorted(known, rolled), len(known) - 1)
        at = np.flatnonzero(known[place] == rolled)
        row = np.searchsorted(words.first, at, "right") - 1
        inside = at + size <= words.first[row + 1]
        at, row = at[inside], row[inside]
        _, firsts = np.unique(row * len(known) + place[at], return_index=True)
        for a, r in zip(at[firsts].tolist(), row[firsts].tolist()):
            for k in short.owners[size][place[a]]:
                if np.array_equal(short.words[k], words.hashes[a : a + size]):
                    found.setdefault((r, k), a - int(words.first[r]))
    return [(r, short.item[k], first) for (r, k), first in found.items()]


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - FREQUENCY_BITS)).astype(np.int64)


def _idf(docs: DataFrame) -> np.ndarray:
    """Inverse document frequency by word bucket, over all rows."""

    def places(block: pa.RecordBatch) -> np.ndarray:
        words = hashed_words(*text_bytes(block.column("text")))
        owner = np.repeat(np.arange(block.num_rows), np.diff(words.first))
        keys = np.unique(owner << FREQUENCY_BITS | _bucket(words.hashes))
        return keys & ((1 << FREQUENCY_BITS) - 1)

    counts = summed_counts(docs, FREQUENCY_BITS, places, "text")
    return np.log((docs.count() + 1) / (counts + 1)).clip(0.05).astype(np.float32)


def _passages(benchmark: DataFrame) -> DataFrame:
    """item_id and word hashes of the passages of all items."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, "text"):
            words = hashed_words(*text_bytes(block.column("text")))
            item, part, hashes = [], [], []
            for k, (a, b) in enumerate(zip(words.first, words.first[1:])):
                n = b - a
                if not n:
                    continue
                pieces = -(-n // PASSAGE_WORDS)  # of about equal length
                edges = [a + n * i // pieces for i in range(pieces + 1)]
                for i, (c, d) in enumerate(zip(edges, edges[1:])):
                    item.append(k)
                    part.append(i)
                    hashes.append(words.hashes[c:d].tobytes())
            yield pa.RecordBatch.from_arrays(
                [block.column("item_id").take(pa.array(item, pa.int64())), pa.array(part, pa.int32()), pa.array(hashes, pa.binary())],
                ["item_id", "part", "words"],
            )

    schema = T.StructType(
        [benchmark.schema["item_id"], T.StructField("part", T.IntegerType()), T.StructField("words", T.BinaryType())]
    )
    return benchmark.mapInArrow(cut, schema)


def _summed(rows: DataFrame, make, shape: tuple[int, int]) -> np.ndarray:
    """The sum over all rows of ``make(list of word arrays)``, a matrix of ``shape``."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            total += make([np.frombuffer(w.as_buffer(), np.uint64) for w in batch.column("words")])
        yield pa.RecordBatch.from_pydict({"part": [total.tobytes()]})

    parts = rows.select("words").coalesce(4).mapInArrow(partial, "part binary")
    return sum((np.frombuffer(r["part"]).reshape(shape) for r in parts.collect()), np.zeros(shape))


def _latent_space(rows: DataFrame, idf: np.ndarray, steps: int) -> Passages | None:
    """Randomised SVD of the TF-IDF matrix of about :data:`RANK` passages, at full rank.

    With fewer directions than passages the cosine of a copy would shrink with the share
    of the passage that the directions leave out.
    """
    listed = rows.orderBy("item_id", "part", "words").collect()
    if not listed:
        return None
    words = [np.frombuffer(r["words"], np.uint64) for r in listed]
    vocabulary = np.unique(_bucket(np.concatenate(words)))
    row_of = np.zeros(1 << FREQUENCY_BITS, np.int32)
    row_of[vocabulary] = np.arange(1, len(vocabulary) + 1)
    weights = np.append(0, idf[vocabulary])

    def matrix(some: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(some), len(weights)))
        for k, hashes in enumerate(some):
            np.add.at(out[k], row_of[_bucket(hashes)], 1)
        out *= weights
        return out / np.maximum(np.linalg.norm(out, axis=1), 1e-9)[:, None]

    rank = min(len(words), len(vocabulary))
    basis = np.linalg.qr(np.random.default_rng(5).standard_normal((len(weights), rank)))[0]
    for _ in range(STEPS):

        def step(some: list[np.ndarray], q=basis) -> np.ndarray:
            a = matrix(some)
            return a.T @ (a @ q)

        basis = np.linalg.qr(_summed(rows, step, basis.shape))[0]

    def inner(some: list[np.ndarray]) -> np.ndarray:
        projected = matrix(some) @ basis
        return projected.T @ projected

    # The basis turned to the singular directions, largest first.
    _, turned = np.linalg.eigh(_summed(rows, inner, (rank, rank)))
    vectors = basis @ turned[:, ::-1]
    latent = np.vstack([matrix([w]) @ vectors for w in words])
    latent /= np.maximum(np.linalg.norm(latent, axis=1), 1e-9)[:, None]
    rare = [set(w[np.argsort(-idf[_bucket(w)], kind="stable")][:ANSWER_WORDS].tolist()) for w in words]
    scaled = (vectors * weights[:, None]).astype(np.float32)
    scaled[0] = 0
    return Passages([r["item_id"] for r in listed], words, row_of, scaled, latent.astype(np.float32), steps, rare)


def common_words(passage: np.ndarray, text: np.ndarray) -> int:
    """Length of the longest common subsequence (bit-parallel)."""
    masks: dict[int, int] = {}
    for k, w in enumerate(passage.tolist()):
        masks[w] = masks.get(w, 0) | 1 << k
    full = (1 << len(passage)) - 1
    row = full
    for w in text.tolist():
        if m := masks.get(w):
            u = row & m
            row = (row + u | row - u) & full
    return len(passage) - row.bit_count()


def best_match(passage: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """The most words in common order within a stretch of the text, and where it begins."""
    size = int(np.ceil(SLACK * len(passage)))
    found = (0, 0)
    least = PARAPHRASE * len(passage)
    present = set(text.tolist())
    if sum(w in present for w in passage.tolist()) < least:
        return found
    for k in range(0, max(1, len(text) - size + len(passage) // 4), max(1, len(passage) // 4)):
        stretch = text[k : k + size]
        present = set(stretch.tolist())
        if sum(w in present for w in passage.tolist()) < max(least, found[0]):
            continue
        n = common_words(passage, stretch)
        found = max(found, (n, -k))
    return found[0], -found[1]


def _windows(first: np.ndarray, squares: np.ndarray, known: np.ndarray, steps: int):
    """First and last word of the windows whose known words weigh enough, and their weights.

    A cosine is at most the share of the known words in the window's length.
    """
    counts = np.diff(first)
    blocks = -(-counts // GRID)
    end_block = np.cumsum(blocks)
    start_block = end_block - blocks
    owner = np.repeat(np.arange(len(counts)), blocks)
    begin = first[:-1][owner] + (np.arange(len(owner)) - start_block[owner]) * GRID
    last = np.minimum(begin + steps * GRID, first[1:][owner])
    total = np.append(0, np.cumsum(squares, dtype=np.float64))
    some = np.append(0, np.cumsum(np.where(known, squares, 0), dtype=np.float64))
    weight = total[last] - total[begin]
    keep = (some[last] - some[begin]) >= 0.999 * LEAST_COSINE**2 * weight
    keep &= weight > 0
    return owner[keep], begin[keep], last[keep], np.sqrt(weight[keep])


def search_block(
    block: pa.RecordBatch, idf: np.ndarray, spaces: list[Passages], short: Short | None = None
) -> list[tuple]:
    """(row, item, cosine, common share, answer share, first word, exact) of the matches."""
    words = hashed_words(*text_bytes(block.column("text")))
    exact = _exact_matches(words, short) if short else []
    found = [(row, item, 1.0, 1.0, 1.0, first, True) for row, item, first in exact]
    if not spaces:
        return found
    bucket = _bucket(words.hashes)
    weight = idf[bucket]
    for held in spaces:
        rows = held.rows[bucket]
        for (row, p), windows in _candidates(words, weight, rows, held).items():
            passage = held.words[p]
            a, b = words.first[row], words.first[row + 1]
            for cosine, begin, last in sorted(windows, reverse=True):
                left = max(a, begin - len(passage))
                text = words.hashes[left : min(b, last + len(passage))]
                n, at = best_match(passage, text)
                share = n / len(passage)
                if share < PARAPHRASE:
                    continue
                stretch = set(text[at : at + int(np.ceil(SLACK * len(passage)))].tolist())
                answer = len(held.answers[p] & stretch) / len(held.answers[p])
                if share >= COPY or answer >= ANSWER_SHARE:
                    found.append((row, held.item[p], cosine, share, answer, int(left + at - a), False))
                    break
    return found


def _candidates(words: Words, weight: np.ndarray, rows: np.ndarray, held: Passages) -> dict[tuple[int, int], list]:
    """(cosine, first word, last word) of the windows near a passage, by text and passage."""
    candidates: dict[tuple[int, int], list] = {}
    owner, begin, last, norm = _windows(words.first, weight * weight, rows > 0, held.steps)
    for k in range(0, len(owner), 512):
        part = slice(k, k + 512)
        lengths = last[part] - begin[part]
        latent = held.vectors[rows[ranges(begin[part], lengths)]]
        latent = np.add.reduceat(latent, np.cumsum(lengths) - lengths, axis=0)
        cosine = latent @ held.latent.T / norm[part][:, None]
        for w, p in zip(*np.nonzero(cosine >= LEAST_COSINE)):
            key = (int(owner[k + w]), int(p))
            candidates.setdefault(key, []).append((float(cosine[w, p]), int(begin[k + w]), int(last[k + w])))
    return candidates


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document (doc_id, text) and benchmark item (item_id, text) found in it.

    Returns doc_id, item_id, cosine, common (share of the passage's words in common
    order), answer (share of its rarest words) and first_word of the best passage, and
    ``exact`` where the item is there word for word: for items of fewer than 16 words,
    the only way for those of fewer than 8. Null and empty texts match nothing; a
    repeated row gives its matches once. Rows without an id are searched, too; other
    columns are ignored; texts of any length are searched whole; an empty table on
    either side gives none.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.lower(whole_text()).alias("text"))
    items = benchmark.select("item_id", F.lower(whole_text()).alias("text"))
    # A passage is compared with windows that are not much longer than itself.
    scale = sum((F.octet_length("words") >= 8 * GRID * steps).cast("int") for steps in SCALES[1:])
    every = materialize(_passages(items).distinct().withColumn("scale", scale), "benchmark-passages")
    size = F.octet_length("words") / 8
    passages = every.filter(size >= LEAST_WORDS)
    brief = every.filter(size < EXACT_WORDS).select("item_id", "words").distinct()
    counts = {r["scale"]: r["count"] for r in passages.groupBy("scale").count().collect()}
    schema = T.StructType(
        [docs.schema["doc_id"], items.schema["item_id"]]
        + [T.StructField(c, T.DoubleType()) for c in ("cosine", "common", "answer")]
        + [T.StructField("first_word", T.LongType()), T.StructField("exact", T.BooleanType())]
    )
    brief_parts = -(-brief.count() // MAX_SHORT)
    if not counts and not brief_parts:
        return spark.createDataFrame([], schema)
    idf = _idf(docs)
    weights = spark.sparkContext.broadcast(idf)
    size = min(RANK, MAX_PASSAGES)
    spaces = []
    for s, n in sorted(counts.items()):
        parts = -(-n // size)
        part_of = F.pmod(F.xxhash64("item_id", "part", "words"), F.lit(parts))
        spaces += [(passages.filter((F.col("scale") == s) & (part_of == k)), SCALES[s]) for k in range(parts)]
    found = None
    at_once = MAX_PASSAGES // size
    brief_part = F.pmod(F.xxhash64("item_id", "words"), F.lit(max(1, brief_parts)))
    for turn in range(max(-(-len(spaces) // at_once), brief_parts)):
        held = [_latent_space(some, idf, steps) for some, steps in spaces[turn * at_once : (turn + 1) * at_once]]
        held = spark.sparkContext.broadcast([h for h in held if h])
        rows = brief.filter(brief_part == turn).collect() if turn < brief_parts else []  # about MAX_SHORT
        short = spark.sparkContext.broadcast(_short_items(rows) if rows else None)
        search = _search(weights, held, short, docs.schema["doc_id"], items.schema["item_id"])
        matches = docs.mapInArrow(search, schema)
        found = matches if found is None else found.unionAll(matches)
    best = F.max(F.struct("common", "cosine", "answer", (-F.col("first_word")).alias("first_word")))
    return found.groupBy("doc_id", "item_id").agg(best.alias("best"), F.bool_or("exact").alias("exact")).select(
        "doc_id", "item_id", "best.cosine", "best.common", "best.answer",
        (-F.col("best.first_word")).alias("first_word"), "exact",
    )


def _search(weights, held, short, doc_field, item_field):
    item_type = to_arrow_type(item_field.dataType)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, "text"):
            found = search_block(block, weights.value, held.value, short.value)
            if not found:
                continue
            row, item, cosine, common, answer, first, exact = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id").take(pa.array(row, pa.int64())),
                    pa.array(item, item_type),
                    *(pa.array(v, pa.float64()) for v in (cosine, common, answer)),
                    pa.array(first, pa.int64()),
                    pa.array(exact, pa.bool_()),
                ],
                ["doc_id", "item_id", "cosine", "common", "answer", "first_word", "exact"],
            )

    return search
