"""Exact removal of repeated byte strings through merged Burrows-Wheeler transforms.

Every byte that a 50-byte string covers goes, if the string also begins in a document
with a smaller id. The work narrows down in steps that lose no such string:

1. Each string has a minimizer: of the hashes of its 19-byte parts the smallest. Equal
   strings have equal minimizers, so only those that differing texts share matter.
2. Documents with such minimizers are cut into short pieces that cover the strings in
   question. A piece is placed by its minimizer: 43 bytes that all its strings contain,
   and up to seven more on either side. Pieces meet by the hash of the 43 bytes, so equal
   strings meet, and no key grows with a document. Where a minimizer is frequent, each
   string is a piece of its own and meets by the hash of all its 50 bytes.
3. Equal pieces are one string with its smallest id. What is left under a key, pieces
   that differ at their ends, is divided into shards, the 43 bytes written as nine
   symbols of their hash. The shards' transforms are merged (:mod:`poolweave.llm.bwt`),
   and blocks with a common prefix of 50 bytes, 16 symbols, are the repeated strings.
   Within a block the smallest id stays.
4. Marks come back to their document, where overlaps are added up.

Exact copies of smaller documents are found by digest and take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolweave.llm.bwt import joined, merged_blocks, sorted_shard
from poolweave.llm.common import mix, ranges, summed_counts, text_blocks, text_bytes, whole_text
from poolweave.session import materialize

LENGTH = 50
PART = 19  # bytes under a minimizer hash
SPAN = LENGTH - PART + 1  # 32 parts in a string
GROUP = 8  # strings that begin within so many bytes share a piece
CORE = LENGTH - GROUP + 1  # bytes that all strings of a piece contain
SEGMENT = 1 << 20  # bytes whose minimizers are computed together
HASH_BITS = 40
NAME = 9  # symbols of 7 bits that stand for the bytes of a core
FLANK = GROUP - 1
CODED = NAME + FLANK  # symbols that stand for a string of 50 bytes
SHARD_STRINGS = 4096
MERGE_STRINGS = 65536  # strings of a merge
HOT_PIECES = 16384  # pieces under one minimizer, above which they are divided into strings
COUNT_BITS = 20  # minimizers are counted by hash: a million counts, whatever the corpus
PART_BYTES = 32 << 20  # text whose minimizers or pieces one task joins

_STEP = np.uint64(0x9E3779B97F4A7C15)  # odd: has an inverse modulo 2**64
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_STEP, SEGMENT + 2 * LENGTH), _powers(_BACK, SEGMENT + 2 * LENGTH)


def _rolling(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which the hash of any stretch follows."""
    return np.append(np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _UP[: len(data)]))


def _stretch(sums: np.ndarray, begin: np.ndarray, length: int) -> np.ndarray:
    return mix((sums[begin + length] - sums[begin]) * _DOWN[begin])


def minimizers(data: np.ndarray, borders: np.ndarray):
    """For every 50-byte string inside a text: begin, minimizer hash, and its place.

    Yields segments: begins, hashes, places (all in ``data``), prefix sums and offset.
    """
    for low in range(0, len(data), SEGMENT):
        part = data[low : low + SEGMENT + LENGTH - 1]
        n = len(part) - LENGTH + 1
        if n <= 0:
            return
        sums = _rolling(part)
        begin = np.arange(len(part) - PART + 1)
        low_bits = np.uint64(64 - HASH_BITS)
        best = (_stretch(sums, begin, PART) >> low_bits << low_bits) | begin.astype(np.uint64)
        width = 1
        while width < SPAN:
            best = np.minimum(best[:-width], best[width:])
            width *= 2
        begin = begin[:n]
        # Strings may not cross from one text to the next.
        end = borders[np.searchsorted(borders, begin + low, "right")]
        inside = begin + low + LENGTH <= end
        begin, best = begin[inside], best[:n][inside]
        place = (best & np.uint64((1 << (64 - HASH_BITS)) - 1)).astype(np.int64)
        yield begin, best >> low_bits, place, sums, low


def _blob(array: np.ndarray) -> bytes:
    return np.ascontiguousarray(array).tobytes()


def _dealt(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions by part of their key, and the parts with where they begin."""
    part = (mix(keys) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    numbers, begin = np.unique(part[order], return_index=True)
    return order, numbers, np.append(begin, len(order))


def _shared_minimizers(docs: DataFrame, parts: int) -> DataFrame:
    """kind (a text's hash) and the minimizers that the text shares with other texts."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, "text"):
            data, borders = text_bytes(block.column("text"))
            owners, hashes = [], []
            for begin, value, _, _, low in minimizers(data, borders):
                text = np.searchsorted(borders, begin + low, "right") - 1
                new = np.ones(len(value), bool)
                new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
                owners.append(text[new])
                hashes.append(value[new])
            if not owners:
                continue
            owner, value = np.concatenate(owners), np.concatenate(hashes)
            kinds = np.asarray(block.column("kind"))
            order, numbers, first = _dealt(value, parts)
            out: dict[str, list] = {c: [] for c in ("kinds", "counts", "hashes")}
            for a, b in zip(first, first[1:]):
                mine = np.sort(order[a:b])
                rows, count = np.unique(owner[mine], return_counts=True)
                out["kinds"].append(_blob(kinds[rows]))
                out["counts"].append(_blob(count.astype(np.uint32)))
                out["hashes"].append(_blob(value[mine].view(np.uint8).reshape(-1, 8)[:, :5]))
            yield pa.RecordBatch.from_pydict({"part": pa.array(numbers, pa.int32()), **out})

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, counts, hashes = _joined_columns(batches, ("<i8", "<u4", "u1"))
        if not len(kinds):
            return
        value = _widened(hashes)
        kind = np.repeat(kinds, counts)
        order = np.argsort(value, kind="stable")
        first = np.flatnonzero(np.append(True, value[order][1:] != value[order][:-1]))
        differ = np.maximum.reduceat(kind[order], first) != np.minimum.reduceat(kind[order], first)
        some = order[np.repeat(differ, np.diff(np.append(first, len(order))))]
        some = some[np.argsort(kind[some], kind="stable")]
        owner, shown = kind[some], value[some].view(np.uint8).reshape(-1, 8)[:, :5]
        place, numbers, cuts = _dealt(owner.view(np.uint64), parts)
        out: dict[str, list] = {c: [] for c in ("kinds", "counts", "hashes")}
        for a, b in zip(cuts, cuts[1:]):
            mine = place[a:b]
            first = np.flatnonzero(np.append(True, _changes([owner], mine)))
            out["kinds"].append(_blob(owner[mine[first]]))
            out["counts"].append(_blob(np.diff(np.append(first, len(mine))).astype(np.uint32)))
            out["hashes"].append(_blob(shown[mine]))
        if len(numbers):
            yield pa.RecordBatch.from_pydict({"part": pa.array(numbers, pa.int32()), **out})

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, counts, hashes = _joined_columns(batches, ("<i8", "<u4", "u1"))
        if not len(kinds):
            return
        kind, value = np.repeat(kinds, counts), _widened(hashes)
        order = np.lexsort((value, kind))
        first = np.flatnonzero(np.append(True, _changes([kind], order)))
        value = value[order]
        for k in range(0, len(first), 1000):
            own = np.append(first, len(order))[k : k + 1001]
            yield pa.RecordBatch.from_pydict(
                {"kind": kind[order[own[:-1]]], "hashes": [_blob(value[a:b]) for a, b in zip(own, own[1:])]}
            )

    layout = "part int, kinds binary, counts binary, hashes binary"
    met = docs.mapInArrow(send, layout).repartition(parts, "part").drop("part")
    found = met.mapInArrow(match, layout).repartition(parts, "part").drop("part")
    return found.mapInArrow(gather, "kind long, hashes binary")


def _widened(hashes: np.ndarray) -> np.ndarray:
    """Minimizer hashes from their five bytes."""
    value = np.zeros((len(hashes) // 5, 8), np.uint8)
    value[:, :5] = hashes.reshape(-1, 5)
    return value.view(np.uint64).ravel()


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, kind and the text as compressed bytes, to be moved."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for block in text_blocks(batches, "text"):
            data, borders = text_bytes(block.column("text"))
            texts = [squeeze.compress(data[a:b].tobytes()) for a, b in zip(borders, borders[1:])]
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), block.column("kind"), pa.array(texts, pa.binary())],
                ["doc_id", "kind", "packed"],
            )

    return docs.mapInArrow(pack, "doc_id long, kind long, packed binary")


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches with ``packed`` as ``text``, a few at a time."""
    expand = zstandard.ZstdDecompressor()
    for batch in batches:
        place = batch.schema.get_field_index("packed")
        for k in range(0, batch.num_rows, 256):
            part = batch.slice(k, 256)
            texts = [expand.decompress(x.as_buffer()) for x in part.column(place)]
            column = pa.array(texts, pa.large_binary())
            yield from text_blocks(iter([part.set_column(place, "text", column)]), "text")


def _joined_columns(batches: Iterator[pa.RecordBatch], kinds: tuple[str, ...]) -> list[np.ndarray]:
    """Each binary column of a task as one array. A task's share is bounded by the number of parts."""
    data: list[list] = [[] for _ in kinds]
    for batch in batches:
        for k in range(len(kinds)):
            data[k].append(text_bytes(batch.column(k))[0].tobytes())
    return [np.frombuffer(b"".join(d), kind) for d, kind in zip(data, kinds)]


_MARKS = "part int, ids binary, kinds binary, rows binary, begins binary, counts binary"


def _marks(ids, kinds, begins, counts, parts: int) -> Iterator[pa.RecordBatch]:
    """Strings to remove, as runs of begins: one row for each part of the documents."""
    if not len(ids):
        return
    order = np.lexsort((begins, kinds, ids))
    ids, kinds, begins, counts = ids[order], kinds[order], begins[order], counts[order]
    place, numbers, cuts = _dealt(ids.view(np.uint64), parts)
    out: dict[str, list] = {c.split()[0]: [] for c in _MARKS.split(", ")[1:]}
    for a, b in zip(cuts, cuts[1:]):
        mine = place[a:b]
        first = np.flatnonzero(np.append(True, _changes([ids, kinds], mine)))
        columns = (ids[mine[first]], kinds[mine[first]], np.diff(np.append(first, len(mine))).astype(np.uint32))
        columns += (begins[mine].astype(np.uint32), counts[mine].astype(np.uint8))
        for name, column in zip(out, columns):
            out[name].append(_blob(column))
    yield pa.RecordBatch.from_pydict({"part": pa.array(numbers, pa.int32()), **out})


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All marks of each document of a task."""
    ids, kinds, rows, begins, counts = _joined_columns(batches, ("<i8", "<i8", "<u4", "<u4", "u1"))
    if not len(ids):
        return
    ids, kinds = np.repeat(ids, rows), np.repeat(kinds, rows)
    order = np.lexsort((kinds, ids))
    first = np.flatnonzero(np.append(True, _changes([ids, kinds], order)))
    begins, counts = begins[order], counts[order]
    for k in range(0, len(first), 1000):
        own = np.append(first, len(order))[k : k + 1001]
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": ids[order[own[:-1]]],
                "kind": kinds[order[own[:-1]]],
                "begins": [_blob(begins[a:b]) for a, b in zip(own, own[1:])],
                "counts": [_blob(counts[a:b]) for a, b in zip(own, own[1:])],
            }
        )


def _bucket(minimizer: np.ndarray) -> np.ndarray:
    return (mix(minimizer) >> np.uint64(64 - COUNT_BITS)).astype(np.int64)


def _hot(lists: DataFrame) -> np.ndarray:
    """By bucket of minimizers, whether more than :data:`HOT_PIECES` places have one.

    A core has one minimizer in all texts, so its pieces are all divided or all whole.
    """

    def places(block: pa.RecordBatch) -> np.ndarray:
        return _bucket(text_bytes(block.column("hashes"))[0].view(np.uint64))

    return summed_counts(lists, COUNT_BITS, places, "hashes") > HOT_PIECES


def _divided(owner: np.ndarray, begin: np.ndarray, whole: list[np.ndarray], hot: np.ndarray):
    """The pieces with each string of a hot one as a piece of its own.

    Such a string has the 7 flank bytes and its place in the group as left flank, and
    their hash with the core's as core.
    """
    left, right = (w.view(np.uint8).reshape(-1, GROUP) for w in whole[1:])
    some = np.flatnonzero(hot)
    count = right[some, FLANK].astype(np.int64)
    piece = np.repeat(some, count)
    k = ranges(np.zeros(len(some), np.int64), count)
    place = left[piece, FLANK] + k
    flank = np.where(np.arange(GROUP) >= place[:, None], left[piece], right[piece])
    flank[:, FLANK] = place
    flank = np.ascontiguousarray(flank).view(np.uint64).ravel()
    alone = [mix(whole[0][piece] ^ mix(flank)), flank, np.full(len(piece), 1 << 56, np.uint64)]
    owner = np.append(owner[~hot], owner[piece])
    begin = np.append(begin[~hot], begin[piece] + k)
    order = np.argsort(owner, kind="stable")
    return owner[order], begin[order], [np.append(w[~hot], a)[order] for w, a in zip(whole, alone)]


def _pieces_of(block: pa.RecordBatch, hot: np.ndarray):
    """The pieces of a block: owner row, begin in its text, and three 64-bit columns:
    core hash; left flank and offset in the group; right flank and number of strings.

    Bytes of a flank that belong to no string of the piece are 0. Pieces whose minimizer
    is in a bucket of ``hot`` are divided.
    """
    data, borders = text_bytes(block.column("text"))
    wanted = [
        np.unique(np.frombuffer(x.as_buffer(), np.uint64)) for x in block.column("hashes")
    ]
    # One sorted list for all rows: hashes mixed with their row.
    rows = np.repeat(np.arange(len(wanted)), [len(w) for w in wanted])
    listed = np.unique(mix(np.concatenate(wanted) + mix(rows.astype(np.uint64))))
    out: list[tuple] = []
    for begin, value, place, sums, low in minimizers(data, borders):
        owner = np.searchsorted(borders, begin + low, "right") - 1
        key = mix(value + mix(owner.astype(np.uint64)))
        at = np.minimum(np.searchsorted(listed, key), max(len(listed) - 1, 0))
        keep = listed[at] == key if len(listed) else np.zeros(len(key), bool)
        begin, place, owner = begin[keep], place[keep], owner[keep]
        if not len(begin):
            continue
        group = (place - begin) // GROUP
        new = np.ones(len(begin), bool)
        new[1:] = (begin[1:] != begin[:-1] + 1) | (place[1:] != place[:-1]) | (group[1:] != group[:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(begin)))
        frame = place[first] - GROUP * group[first] - FLANK
        core = _stretch(sums, frame + FLANK, CORE)
        often = hot[_bucket(value[keep][first])]
        out.append((owner[first], begin[first] + low, count, frame + low, core, often))
    if not out:
        return None
    owner, begin, count, frame, core, often = (np.concatenate(x) for x in zip(*out))
    offset = begin - frame
    padded = np.concatenate([np.zeros(FLANK, np.uint8), data, np.zeros(FLANK, np.uint8)])
    flank = np.arange(FLANK)
    left, right = np.zeros((2, len(owner), GROUP), np.uint8)
    left[:, :FLANK] = padded[frame[:, None] + FLANK + flank] * (flank >= offset[:, None])
    left[:, FLANK] = offset
    right[:, :FLANK] = padded[frame[:, None] + FLANK + LENGTH + flank] * (flank < (offset + count - 1)[:, None])
    right[:, FLANK] = count
    whole = [core, left.view(np.uint64).ravel(), right.view(np.uint64).ravel()]
    return _divided(owner, begin - borders[owner], whole, often)


def _least(whole: list[np.ndarray], ids: np.ndarray) -> np.ndarray:
    """For each piece the smallest id among the pieces that equal it."""
    order = np.lexsort((ids, *whole[::-1]))
    first = np.append(True, _changes(whole, order))[: len(order)]
    least = np.empty(len(ids), ids.dtype)
    least[order] = ids[order][np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
    return least


def _changes(columns: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    """Where neighbours in this order differ in any column."""
    return np.logical_or.reduce([c[order][1:] != c[order][:-1] for c in columns])


def _send_pieces(marks: bool, parts: int, hot):
    """Pieces by part of their core; or, with ``marks``, the strings of pieces that the
    same block has under a smaller id, which need not be sent."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _unpacked(batches):
            made = _pieces_of(block, hot.value)
            if made is None:
                continue
            owner, begin, whole = made
            ids, kinds = np.asarray(block.column("doc_id")), np.asarray(block.column("kind"))
            later = ids[owner] > _least(whole, ids[owner])
            if marks:
                count = (whole[2] >> np.uint64(56)).astype(np.int64)
                yield from _marks(ids[owner[later]], kinds[owner[later]], begin[later], count[later], parts)
                continue
            keep = np.flatnonzero(~later)
            order, numbers, first = _dealt(whole[0][keep], parts)
            names = ("ids", "kinds", "rows", "begins", "cores", "lefts", "rights")
            out: dict[str, list] = {c: [] for c in names}
            for a, b in zip(first, first[1:]):
                mine = np.sort(keep[order[a:b]])
                rows, n = np.unique(owner[mine], return_counts=True)
                columns = (ids[rows], kinds[rows], n.astype(np.uint32), begin[mine].astype(np.uint32))
                for name, column in zip(names, (*columns, *(w[mine] for w in whole))):
                    out[name].append(_blob(column))
            yield pa.RecordBatch.from_pydict({"part": pa.array(numbers, pa.int32()), **out})

    return send


def _match_pieces(parts: int):
    """Marks for all pieces of a task."""

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for marks in _matched(batches):
            yield from _marks(*marks, parts)

    return match


def _matched(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    layout = ("<i8", "<i8", "<u4", "<u4", "<u8", "<u8", "<u8")
    ids, kinds, rows, begin, *whole = _joined_columns(batches, layout)
    if not len(ids):
        return
    ids, kinds = np.repeat(ids, rows), np.repeat(kinds, rows)
    # A core that only one document has repeats nothing.
    by_core = np.argsort(whole[0], kind="stable")
    keep = by_core[_several(whole[0][by_core], ids[by_core])]
    ids, kinds, begin = ids[keep], kinds[keep], begin[keep].astype(np.int64)
    whole = [w[keep] for w in whole]
    count = (whole[2] >> np.uint64(56)).astype(np.int64)
    later = ids > _least(whole, ids)
    yield ids[later], kinds[later], begin[later], count[later]
    stay = np.flatnonzero(~later)
    # One string for each content; its other pieces of the same id share its marks.
    order = stay[np.lexsort((whole[2][stay], whole[1][stay], whole[0][stay]))]
    if not len(order):
        return
    new = np.append(True, _changes(whole, order))
    string_of = np.cumsum(new) - 1
    heads = order[new]
    # Only cores with strings of different ids are left to merge.
    open_ = np.flatnonzero(_several(whole[0][heads], ids[heads]))
    flags = np.zeros((len(heads), GROUP), bool)
    cores = whole[0][heads[open_]]
    low = 0
    while low < len(open_):
        high = min(low + MERGE_STRINGS, len(open_))
        if high < len(open_):  # never within a core
            first = int(np.searchsorted(cores, cores[high], "left"))
            high = first if first > low else int(np.searchsorted(cores, cores[high], "right"))
        some = heads[open_[low:high]]
        flags[open_[low:high]] = _merged_flags([w[some] for w in whole], ids[some])
        low = high
    piece, k = np.nonzero(flags[string_of])
    piece = order[piece]
    yield ids[piece], kinds[piece], begin[piece] + k, np.ones(len(k), np.int64)


def _several(keys: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Of sorted keys, those with more than one id."""
    if not len(keys):
        return np.zeros(0, bool)
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    several = np.maximum.reduceat(ids, first) != np.minimum.reduceat(ids, first)
    return np.repeat(several, np.diff(np.append(first, len(keys))))


def _coded(whole: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces as strings of symbols, their lengths, and their offsets in the group."""
    left, right = (w.view(np.uint8).reshape(-1, GROUP) for w in whole[1:])
    offset, count = left[:, FLANK].astype(np.int64), right[:, FLANK].astype(np.int64)
    shift = np.uint64(57) - np.uint64(7) * np.arange(NAME, dtype=np.uint64)
    name = (whole[0][:, None] >> shift & np.uint64(127)).astype(np.uint8)
    wide = np.hstack([left[:, :FLANK], name, right[:, :FLANK], np.zeros((len(name), FLANK), np.uint8)])
    return np.take_along_axis(wide, offset[:, None] + np.arange(CODED + FLANK), 1), CODED + count - 1, offset


def _merged_flags(whole: list[np.ndarray], ids: np.ndarray) -> np.ndarray:
    """Which 50-byte strings of each piece a piece with a smaller id has, too."""
    coded, length, offset = _coded(whole)
    size = max(SHARD_STRINGS, -(-len(coded) // 64))
    shards = [sorted_shard(*joined(coded[k : k + size], length[k : k + size])) for k in range(0, len(coded), size)]
    shard, position, block = merged_blocks(shards, CODED)
    string, begin = np.empty((2, len(shard)), np.int64)
    for k, s in enumerate(shards):
        rows = shard == k
        own = s.string[position[rows]]
        string[rows] = own + k * size
        begin[rows] = position[rows] - np.searchsorted(s.string, own)
    kept = begin + CODED <= length[string]
    string, begin, block = string[kept], begin[kept], block[kept]
    # Names could look like flanks: only equal places in the group are equal strings.
    key = block * GROUP + begin + offset[string]
    order = np.argsort(key, kind="stable")
    first = np.append(True, key[order][1:] != key[order][:-1])[: len(order)]
    least = np.minimum.reduceat(ids[string[order]], np.flatnonzero(first)) if len(order) else ids[:0]
    later = order[ids[string[order]] > least[np.cumsum(first) - 1]]
    flags = np.zeros((len(coded), GROUP), bool)
    flags[string[later], begin[later]] = True
    return flags


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add up a document's marks and cut them out."""
    for block in _unpacked(batches):
        out: dict[str, list] = {"n_removed": [], "n_spans": [], "kept_sha256": []}
        data, borders = text_bytes(block.column("text"))
        for k in range(block.num_rows):
            own = data[borders[k] : borders[k + 1]]
            begin = np.frombuffer(block.column("begins")[k].as_buffer(), np.uint32)
            count = np.frombuffer(block.column("counts")[k].as_buffer(), np.uint8)
            change = np.zeros(len(own) + 1, np.int64)
            np.add.at(change, begin, 1)
            np.add.at(change, begin + count.astype(np.int64) + LENGTH - 1, -1)
            gone = np.cumsum(change[:-1]) > 0
            out["n_removed"].append(int(gone.sum()))
            out["n_spans"].append(int((gone & ~np.append(False, gone[:-1])).sum()))
            out["kept_sha256"].append(hashlib.sha256(own[~gone].tobytes()).hexdigest())
        yield pa.RecordBatch.from_pydict({"doc_id": block.column("doc_id"), "kind": block.column("kind"), **out})


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row (doc_id, text).

    Texts are judged as UTF-8 bytes. A null text is the empty one; a text below 50 bytes
    keeps all. Rows with the same id do not count against each other, whether their
    texts agree or not; rows without id are left out, other columns are ignored. Texts
    of any length are judged whole; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    docs = docs.filter(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")
    )
    kinds = docs.select("doc_id", F.xxhash64("text").alias("kind"), "text")
    keyed = kinds.filter(F.octet_length("text") >= LENGTH)
    facts = kinds.select(
        "doc_id", "kind", F.sha2("text", 256).alias("whole_sha256"),
        F.octet_length("text").cast("long").alias("n_bytes"),
    )
    facts = materialize(facts, "text-facts")
    least = materialize(facts.groupBy("whole_sha256").agg(F.min("doc_id").alias("least_id")), "text-owners")
    facts = materialize(facts.join(least, "whole_sha256"), "owned-facts")
    copied = (F.col("least_id") < F.col("doc_id")) & (F.col("n_bytes") >= LENGTH)
    total = facts.agg(F.sum("n_bytes")).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PART_BYTES))

    shared = _shared_minimizers(keyed, parts)
    first = facts.filter(~copied & (F.col("n_bytes") >= LENGTH)).select("doc_id", "kind").distinct()
    lists = materialize(shared.join(first, "kind"), "shared-minimizers")
    hot = spark.sparkContext.broadcast(_hot(lists))
    open_docs = _packed(keyed).join(lists, ["doc_id", "kind"]).select("doc_id", "kind", "packed", "hashes")
    layout = "part int, ids binary, kinds binary, rows binary, begins binary, cores binary, lefts binary, rights binary"
    sent = open_docs.mapInArrow(_send_pieces(False, parts, hot), layout)
    marks = sent.repartition(parts, "part").drop("part").mapInArrow(_match_pieces(parts), _MARKS)
    local = open_docs.mapInArrow(_send_pieces(True, parts, hot), _MARKS)
    gathered = marks.unionAll(local).repartition(parts, "part").drop("part").mapInArrow(
        _gather, "doc_id long, kind long, begins binary, counts binary"
    )
    gathered = materialize(gathered, "repeats")
    marked = _packed(keyed).join(gathered, ["doc_id", "kind"]).select("doc_id", "kind", "packed", "begins", "counts")
    changed = marked.mapInArrow(_apply, "doc_id long, kind long, n_removed long, n_spans long, kept_sha256 string")
    changed = materialize(changed.dropDuplicates(["doc_id", "kind"]), "changed-texts")
    nothing = F.lit(0).cast("long")
    return facts.join(changed, ["doc_id", "kind"], "left").select(
        "doc_id",
        "n_bytes",
        F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("n_removed", nothing)).alias("n_removed"),
        F.when(copied, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", nothing)).alias("n_spans"),
        F.when(copied, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "whole_sha256")).alias("kept_sha256"),
    )
