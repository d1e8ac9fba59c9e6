"""Exact Jaccard join of word-shingle sets with set-relation skipping.

A document's set is ordered rarest shingle first (by counts over all documents), and
only a prefix of it is indexed: sets that reach the threshold share a prefix shingle.
Two kinds of work are skipped:

* in an index list, which is sorted by set size and then position, everything of a
  size block beyond the position from which the threshold is out of reach, and pairs
  whose parity sketches (of 128 bits) differ in more bits than similar sets' elements;
* equal sets are one set, and a set that differs little from another (its leader) is
  described by the difference. Answers between sets of one leader are derived from the
  differences alone, and pairs that are connected already need no answer.

Links are exact for 59-bit shingle hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolweave.llm.common import (
    hashed_words,
    mix,
    ranges,
    rows_per_batch,
    shingle_hashes,
    summed_counts,
    text_blocks,
    text_bytes,
    whole_text,
)
from poolweave.llm.components import components
from poolweave.session import materialize

COUNT_BITS = 21  # counts of shingles by hash: 2 million, whatever the corpus
LEVEL_BITS = 5
WAITING_PAIRS = 1 << 20  # that a task holds, before they leave it without repeats
FOLLOWERS = 64  # sets that are compared with one copy of their leader's
BATCH_ROWS = 1000  # sets and texts sent to a task at once
LONG_LIST = 1000  # index lists above this length are dealt out over several tasks


@dataclass(frozen=True)
class Spec:
    """Words of a shingle, and the threshold as a fraction."""

    words: int = 3
    num: int = 90
    den: int = 100

    def least_size(self, n):
        """The smallest size of a set that can reach the threshold with one of size n."""
        return -(-self.num * n // self.den)

    def least_common(self, a, b):
        """How many shingles two sets of these sizes must share."""
        return -(-self.num * (a + b) // (self.num + self.den))


def _levels(docs: DataFrame, spec: Spec) -> np.ndarray:
    """The logarithm of the number of documents with a shingle, by the shingle's hash."""

    def places(block: pa.RecordBatch) -> np.ndarray:
        hashes, _ = _distinct(block.column("text"), spec, None)
        return (hashes >> np.uint64(64 - COUNT_BITS)).astype(np.int64)

    counts = summed_counts(docs, COUNT_BITS, places, "text")
    return np.minimum(2 * np.log2(counts + 1.0), (1 << LEVEL_BITS) - 1).astype(np.uint8)


def _record(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def _distinct(texts: pa.Array, spec: Spec, levels: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingles in order, and where each text's begin.

    With levels, a shingle is its level above the upper bits of its hash.
    """
    hashes, first = shingle_hashes(hashed_words(*text_bytes(texts)), spec.words)
    if levels is not None:
        level = levels[(hashes >> np.uint64(64 - COUNT_BITS)).astype(np.int64)].astype(np.uint64)
        hashes = (level << np.uint64(64 - LEVEL_BITS)) | (hashes >> np.uint64(LEVEL_BITS))
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for k in range(len(first) - 1):
        hashes[first[k] : first[k + 1]].sort()
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], np.append(0, np.cumsum(np.bincount(owner[new], minlength=len(first) - 1)))


def _binary_lists(data: np.ndarray, first: np.ndarray) -> pa.Array:
    """The ranges of a 64-bit array as binary values."""
    data = np.ascontiguousarray(data)
    return pa.Array.from_buffers(
        pa.large_binary(), len(first) - 1, [None, pa.py_buffer((first * 8).astype(np.int64)), pa.py_buffer(data)]
    ).cast(pa.binary())


def _profiles(docs: DataFrame, spec: Spec, levels) -> DataFrame:
    """doc_id, the set's parity sketch, size, digest, and index prefix."""

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, "text"):
            sets, first = _distinct(block.column("text"), spec, levels.value)
            sizes = np.diff(first)
            digests = [
                hashlib.blake2b(sets[a:b].tobytes(), digest_size=16).digest() for a, b in zip(first, first[1:])
            ]
            # So small a set can only equal another: one shingle more is too much.
            small = spec.den * sizes < spec.num * (sizes + 1)
            taken = np.where(small, 0, sizes - spec.least_size(sizes) + 1)
            prefix = sets[ranges(first[:-1], taken)]
            yield _record(
                doc_id=block.column("doc_id").cast(pa.int64()),
                sketch=_sketches(sets, first),
                n_shingles=pa.array(sizes, pa.int64()),
                digest=pa.array(digests, pa.binary()),
                prefix=_binary_lists(prefix, np.append(0, np.cumsum(taken))),
            )

    return docs.mapInArrow(profile, "doc_id long, sketch binary, n_shingles long, digest binary, prefix binary")


def _sketches(sets: np.ndarray, first: np.ndarray) -> pa.Array:
    """128 bits for each set; every element flips one of them."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    place = (owner << 7) | (mix(sets) >> np.uint64(57)).astype(np.int64)
    odd = np.bincount(place, minlength=(len(first) - 1) << 7) & 1
    bits = np.packbits(odd.astype(np.uint8)).tobytes()
    return pa.array([bits[k : k + 16] for k in range(0, len(bits), 16)], pa.binary())


def _entries(sets: DataFrame) -> DataFrame:
    """One row per prefix shingle of a set: the index."""

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, borders = text_bytes(batch.column("prefix"))
            n = np.diff(borders) // 8
            bits = np.frombuffer(text_bytes(batch.column("sketch"))[0].tobytes(), np.int64).reshape(-1, 2)
            doc = np.repeat(np.asarray(batch.column("doc_id")), n)
            zero = pa.array(np.zeros(len(doc)), pa.int32())
            yield _record(
                token=np.frombuffer(data.tobytes(), np.int64),
                size=pa.array(np.repeat(np.asarray(batch.column("n_shingles")), n), pa.int32()),
                pos=pa.array(ranges(np.zeros(len(n), np.int64), n), pa.int32()),
                doc=doc,
                part=zero,
                other=zero,
                mine=zero,
                bits_1=np.repeat(bits[:, 0], n),
                bits_2=np.repeat(bits[:, 1], n),
                component=doc,
            )

    return sets.mapInArrow(unfold, _ENTRY)


def list_pairs(size: np.ndarray, pos: np.ndarray, lists: np.ndarray, spec: Spec) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of entries of the same list that can reach the threshold.

    Entries are sorted by list, size, position. Every entry meets the blocks of its
    list with its own or a smaller size, and of a block only the first positions.
    """
    n = len(size)
    new = np.ones(n, bool)
    new[1:] = (lists[1:] != lists[:-1]) | (size[1:] != size[:-1])
    start = np.flatnonzero(new)
    block = np.cumsum(new) - 1
    end = np.append(start[1:], n)
    reach = np.int64(pos.max(initial=0)) + 2
    order = block.astype(np.int64) * reach + pos
    out_a, out_b = [], []
    active, back = np.arange(n), 0
    while len(active):
        target = block[active] - back
        active, target = active[target >= 0], target[target >= 0]
        own, smaller = size[active].astype(np.int64), size[start[target]].astype(np.int64)
        near = (lists[active] == lists[start[target]]) & (smaller >= spec.least_size(own))
        active, target, own, smaller = active[near], target[near], own[near], smaller[near]
        common = spec.least_common(own, smaller)
        possible = own - pos[active] >= common
        some, to = active[possible], target[possible]
        last = np.minimum(smaller - common, reach - 2)[possible]  # the last position of use
        stop = np.searchsorted(order, to * reach + last, "right")
        stop = np.minimum(stop, end[to])
        if back == 0:
            stop = np.minimum(stop, some)  # of a block with itself, each pair once
        count = np.maximum(stop - start[to], 0)
        out_a.append(ranges(start[to], count))
        out_b.append(np.repeat(some, count))
        back += 1
    return np.concatenate(out_a or [np.zeros(0, np.int64)]), np.concatenate(out_b or [np.zeros(0, np.int64)])


def _candidates(entries: DataFrame, spec: Spec, first_round: bool, split: bool) -> DataFrame:
    """What index lists say about sets that can be similar.

    In the first round every entry gives one pair (x, y) with its smallest partner, and
    comes back itself if it has any; the number of rows is linear. Later the entries
    know their component, and pairs (x, y) across components come back. With ``split``
    entries of long lists come back with the list's length and are not paired.
    """

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n_waiting = [], 0
        for columns in _whole_lists(batches):
            token, _, _, _, part, other, *_ = columns
            new = np.ones(len(token), bool)
            new[1:] = (token[1:] != token[:-1]) | (part[1:] != part[:-1]) | (other[1:] != other[:-1])
            lists = np.cumsum(new) - 1
            length = np.bincount(lists)[lists]
            long = (length > LONG_LIST) & split
            if long.any():
                yield _entries_back([c[long] for c in columns], length[long])
            keep = ~long & (length > 1)
            columns, lists, length = [c[keep] for c in columns], lists[keep], length[keep]
            # A few lists at a time: as many as have a bounded number of pairs.
            heads = np.flatnonzero(np.append(True, lists[1:] != lists[:-1])[: len(lists)])
            work = np.cumsum(length[heads].astype(np.int64) ** 2) // WAITING_PAIRS
            cuts = np.append(heads[np.append(True, work[1:] != work[:-1])[: len(heads)]], len(lists))
            for low, high in zip(cuts, cuts[1:]):
                some = [c[low:high] for c in columns]
                a, b = _similar(some, lists[low:high], spec)
                doc, component = some[3], some[9]
                if first_round:
                    a, b = np.append(a, b), np.append(b, a)
                    order = np.lexsort((doc[b], a))
                    a, b = a[order], b[order]
                    one = np.append(True, a[1:] != a[:-1])[: len(a)]
                    a, b = a[one], b[one]
                    if len(a):
                        yield _entries_back([c[a] for c in some])
                else:
                    apart = component[a] != component[b]
                    a, b = a[apart], b[apart]
                x, y = doc[a], doc[b]
                waiting.append(np.stack([np.minimum(x, y), np.maximum(x, y)]))
                n_waiting += len(x)
            if n_waiting > WAITING_PAIRS:
                waiting = [np.unique(np.hstack(waiting), axis=1)]
                if waiting[0].shape[1] > WAITING_PAIRS // 2:
                    yield _pairs_found(*waiting.pop())
                n_waiting = sum(w.shape[1] for w in waiting)
        if n_waiting:
            yield _pairs_found(*np.unique(np.hstack(waiting), axis=1))

    arranged = entries.repartition("token", "part", "other").sortWithinPartitions(
        "token", "part", "other", "size", "pos", "doc"
    )
    return arranged.select(*_COLUMNS).mapInArrow(pair, f"x long, y long, length long, {_ENTRY}")


def _similar(columns: list[np.ndarray], lists: np.ndarray, spec: Spec) -> tuple[np.ndarray, np.ndarray]:
    """Positions of pairs in the same list that sizes, positions and sketches allow."""
    _, size, pos, doc, part, other, mine, bits_1, bits_2, _ = columns
    a, b = list_pairs(size, pos, lists, spec)
    # Where two parts of a list meet, only pairs across them are new.
    fresh = (part[a] == other[a]) | (mine[a] != mine[b])
    fresh &= doc[a] != doc[b]
    # Every element of the symmetric difference changes at most one bit.
    first, second = bits_1.view(np.uint64), bits_2.view(np.uint64)
    changed = np.bitwise_count(first[a] ^ first[b]).astype(np.int64)
    changed += np.bitwise_count(second[a] ^ second[b])
    both = size[a].astype(np.int64) + size[b]
    fresh &= changed <= both - 2 * spec.least_common(both, 0)
    return a[fresh], b[fresh]


_COLUMNS = ("token", "size", "pos", "doc", "part", "other", "mine", "bits_1", "bits_2", "component")
_ENTRY = (
    "token long, size int, pos int, doc long, part int, other int, mine int, "
    "bits_1 long, bits_2 long, component long"
)


def _entries_back(columns: list[np.ndarray], length: np.ndarray | None = None) -> pa.RecordBatch:
    none = pa.nulls(len(columns[0]), pa.int64())
    lengths = none if length is None else pa.array(length, pa.int64())
    return _record(x=none, y=none, length=lengths, **dict(zip(_COLUMNS, columns)))


def _pairs_found(x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
    n = len(x)
    kinds = (f.split() for f in _ENTRY.split(", "))
    empty = {c: pa.nulls(n, pa.int64() if kind == "long" else pa.int32()) for c, kind in kinds}
    return _record(x=x, y=y, length=pa.nulls(n, pa.int64()), **empty)


def _paired(entries: DataFrame, spec: Spec, first_round: bool, name: str) -> DataFrame:
    """All that :func:`_candidates` finds, with long lists dealt out."""
    found = materialize(_candidates(entries, spec, first_round, split=True), name)
    long = _candidates(_dealt(found.filter("length IS NOT NULL")), spec, first_round, split=False)
    return found.filter("length IS NULL").unionAll(long)


def _whole_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns of sorted entries, cut between lists."""
    kept: list[np.ndarray] | None = None
    for batch in batches:
        now = [np.asarray(c) for c in batch.columns]
        now = now if kept is None else [np.concatenate(p) for p in zip(kept, now)]
        if not len(now[0]):
            continue
        same = (now[0] == now[0][-1]) & (now[4] == now[4][-1]) & (now[5] == now[5][-1])
        first = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
        kept = [c[first:] for c in now]
        if first:
            yield [c[:first] for c in now]
    if kept is not None and len(kept[0]):
        yield kept


def _dealt(long: DataFrame) -> DataFrame:
    """Entries of long lists, in parts: each two parts of a list meet once."""
    parts = F.ceil(F.col("length") / (LONG_LIST / 2)).cast("int")
    mine = F.pmod(F.xxhash64("doc"), parts).cast("int")
    whole = long.withColumn("mine", mine).withColumn("with", F.explode(F.sequence(F.lit(0), parts - 1)))
    placed = {"part": F.least("mine", "with"), "other": F.greatest("mine", "with")}
    return whole.withColumns(placed).select(*_COLUMNS)


def _numbers(value) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), np.uint64)


def _compare(pairs: DataFrame, docs: DataFrame, classes: DataFrame, spec: Spec, levels) -> DataFrame:
    """x, y, linked, and what y has more (added) and less (removed) than x.

    The sets are built from the texts again, and every y's set moves once, to a copy of
    x's; an x with many partners has many copies.
    """
    copies = pairs.groupBy("x").agg(F.ceil(F.count(F.lit(1)) / FOLLOWERS).cast("int").alias("copies"))
    copies = materialize(copies, "leaders")
    place = F.pmod(F.xxhash64("y"), F.col("copies")).cast("int")
    placed = pairs.join(copies, "x").select("x", "y", place.alias("copy"))
    own = copies.select("x", F.col("x").alias("y"), F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
    both = own.withColumn("is_y", F.lit(False)).unionAll(placed.withColumn("is_y", F.lit(True)))
    roles = both.join(classes.select(F.col("doc_id").alias("y"), "digest"), "y")
    texts = docs.select(F.col("doc_id").alias("y"), "text").join(roles, "y")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, "text"):
            sets, first = _distinct(block.column("text"), spec, levels.value)
            keep = [
                hashlib.blake2b(sets[a:b].tobytes(), digest_size=16).digest() == digest
                for a, b, digest in zip(first, first[1:], block.column("digest").to_pylist())
            ]
            rows = {c: block.column(c) for c in ("x", "y", "copy", "is_y")}
            yield _record(**rows, items=_binary_lists(sets, first)).filter(pa.array(keep))

    loaded = texts.select("x", "y", "copy", "is_y", "text", "digest").mapInArrow(
        build, "x long, y long, copy int, is_y boolean, items binary"
    )
    arranged = loaded.repartition("x", "copy").sortWithinPartitions("x", "copy", "is_y", "y")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last, a = None, None, np.zeros(0, np.uint64)
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("x", "y", "linked", "added", "removed", "size")}
            columns = (batch.column(c).to_pylist() for c in ("x", "y", "is_y"))
            for x, y, is_y, items in zip(*columns, batch.column("items")):
                b = _numbers(items)
                if not is_y:
                    held, last, a = x, None, b
                    continue
                if y == last:  # of a repeated row
                    continue
                last = y
                if held != x:
                    raise ValueError("a set came without its leader's")
                common = np.intersect1d(a, b, assume_unique=True)
                linked = len(common) >= spec.least_common(len(a), len(b))
                added, removed = (np.setdiff1d(s, common, assume_unique=True).tobytes() for s in (b, a))
                for name, value in zip(out, (x, y, bool(linked), added, removed, len(a))):
                    out[name].append(value)
            if out["x"]:
                yield _record(**(out | {"size": pa.array(out["size"], pa.int32())}))

    return arranged.select("x", "y", "is_y", "items").mapInArrow(
        compare, "x long, y long, linked boolean, added binary, removed binary, size int"
    )


def _derive(pairs: DataFrame, spec: Spec) -> DataFrame:
    """Links among pairs whose two sets are described by differences from one leader."""

    def derive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            columns = (batch.column(c) for c in ("added_x", "removed_x", "added_y", "removed_y"))
            for more_x, less_x, more_y, less_y, n in zip(*columns, batch.column("size").to_pylist()):
                more_x, less_x, more_y, less_y = map(_numbers, (more_x, less_x, more_y, less_y))
                gone = len(np.union1d(less_x, less_y))
                both = n - gone + len(np.intersect1d(more_x, more_y, assume_unique=True))
                a, b = n + len(more_x) - len(less_x), n + len(more_y) - len(less_y)
                linked.append(bool(both >= spec.least_common(a, b)))
            yield _record(x=batch.column("x"), y=batch.column("y"), linked=linked)

    return pairs.mapInArrow(derive, "x long, y long, linked boolean")


def similar_sets(docs: DataFrame, spec: Spec = Spec()) -> DataFrame:
    """doc_id, n_shingles, component_id of every document of ``docs`` (doc_id, text).

    Documents are linked when their sets' Jaccard similarity reaches the threshold; a
    component is named by its smallest doc_id. A text that is null or has no word has
    the empty set and is linked with nothing. Of several rows with one doc_id the one
    whose set has the smallest digest counts; rows without doc_id are left out, other
    columns are ignored. Sets are made of whole texts of any length; an empty table gives
    an empty one.
    """
    with rows_per_batch(docs.sparkSession, BATCH_ROWS):
        return _similar_sets(docs, spec)


def _similar_sets(docs: DataFrame, spec: Spec) -> DataFrame:
    spark = docs.sparkSession
    docs = docs.filter(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")
    )
    levels = spark.sparkContext.broadcast(_levels(docs, spec))
    profiles = materialize(_profiles(docs, spec, levels), "set-profiles")
    if not profiles.groupBy("doc_id").count().filter("count > 1").isEmpty():
        one_each = F.min(F.struct("digest", "n_shingles", "prefix", "sketch"))
        profiles = profiles.groupBy("doc_id").agg(one_each.alias("p")).select("doc_id", "p.*")
        profiles = materialize(profiles, "distinct-profiles")
    # Equal sets are one set, represented by the smallest id.
    first = F.min(F.struct("doc_id", "n_shingles", "prefix", "sketch"))
    classes = materialize(
        profiles.filter("n_shingles > 0").groupBy("digest").agg(first.alias("p")).select("digest", "p.*"),
        "set-classes",
    )
    found = materialize(_paired(_entries(classes), spec, True, "index-lists"), "first-round")
    entries = found.filter("token IS NOT NULL").dropDuplicates(["token", "doc"])
    # A set is described by its difference from its leader, its smallest first partner.
    leaders = found.filter("x IS NOT NULL").groupBy("y").agg(F.min("x").alias("x"))
    led = materialize(_compare(leaders, docs, classes, spec, levels), "led-sets")
    links = led.filter("linked").select(F.col("x").alias("a"), F.col("y").alias("b"))
    settled = materialize(components(links), "settled")
    # Only entries of different components have anything left to answer.
    named = settled.select(F.col("node").alias("doc"), F.col("component").alias("settled"))
    known = entries.select(*_COLUMNS[:4], *(F.lit(0).alias(c) for c in _COLUMNS[4:7]), *_COLUMNS[7:9])
    known = known.join(named, "doc", "left").withColumn("component", F.coalesce("settled", "doc"))
    pairs = _paired(known.select(*_COLUMNS), spec, False, "index-lists").filter("x IS NOT NULL")
    rest = materialize(_open_pairs(pairs.select("x", "y").distinct(), led), "open-pairs")
    side = lambda name: led.select(
        F.col("y").alias(name), F.col("x").alias(f"leader_{name}"), F.col("added").alias(f"added_{name}"),
        F.col("removed").alias(f"removed_{name}"), *(["size"] if name == "x" else []),
    )
    near = rest.filter("same_leader").select("x", "y").join(side("x"), "x").join(side("y"), "y")
    far = rest.filter("NOT same_leader").select("x", "y")
    more = _derive(near, spec).unionAll(_compare(far, docs, classes, spec, levels).select("x", "y", "linked"))
    known = settled.select(F.col("node").alias("a"), F.col("component").alias("b"))
    all_links = known.unionAll(more.filter("linked").select(F.col("x").alias("a"), F.col("y").alias("b")))
    named = materialize(components(all_links), "set-components").withColumnRenamed("node", "rep")
    reps = classes.select("digest", F.col("doc_id").alias("rep")).join(named, "rep", "left")
    reps = materialize(reps, "class-components")
    return profiles.select("doc_id", "n_shingles", "digest").join(
        reps.select("digest", F.coalesce("component", "rep").alias("named")), "digest", "left"
    ).select("doc_id", "n_shingles", F.coalesce("named", "doc_id").alias("component_id"))


def _open_pairs(pairs: DataFrame, led: DataFrame) -> DataFrame:
    """Pairs that no leader has answered, and whether both have the same leader."""
    for side in ("x", "y"):
        leader = led.select(F.col("y").alias(side), F.col("x").alias(f"leader_{side}"))
        pairs = pairs.join(leader, side, "left")
    answered = F.coalesce(F.col("leader_y") == F.col("x"), F.lit(False))
    same = F.coalesce(F.col("leader_x") == F.col("leader_y"), F.lit(False))
    return pairs.filter(~answered).select("x", "y", same.alias("same_leader"))
