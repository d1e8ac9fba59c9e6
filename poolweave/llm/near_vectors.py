"""Links between vectors of high cosine, by p-stable hashing of normalised vectors.

A table of the index projects a unit vector on ``k`` random directions, shifts and
divides by a width, and takes the integers below as a bucket (Datar et al.). The
distance of unit vectors follows from their cosine, so the chance that a linked pair
meets in a table is known; ``k`` follows from the number of vectors, the number of
tables from the chance that a pair just at the threshold may be missed. Vectors that
meet are compared by 64 sign bits first, then exactly.

Large groups of near copies would meet in pairs, so they are found beforehand: a
bounded sample shows where vectors crowd, and all vectors within half the linking angle
of such a centre are a cell whose members are linked with each other, whatever their
number. Every vector is held against every centre; only those for which the triangle
inequality leaves it open are compared with a cell's members, block by block.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poolweave.llm.components import components
from poolweave.session import materialize

COSINE = 0.95
MISSED = 0.005  # chance that no table has a pair just at the threshold
WIDTH = 2.0
CROWD = 8  # a bucket is expected to hold so many vectors that have nothing in common
SAMPLE = 4096  # distinct vectors in which centres are looked for
CENTRE = 8  # members of the sample that make a centre; so at most SAMPLE / CENTRE centres
BLOCK = 512  # vectors of a cell compared at once
SIGN_BITS = 64
MOST_DIFFERENT = 22  # of the sign bits; at the threshold 6.5 are expected
_SLACK = 1e-6  # of an angle, far above rounding

_PAIR = "a bigint, b bigint"


def _meeting_chance(distance: float) -> float:
    """Of two vectors so far apart, in one of the ``k`` projections."""
    x = WIDTH / distance
    tail = 0.5 * math.erfc(x / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * x) * (1 - math.exp(-x * x / 2))


@dataclass(frozen=True)
class Tables:
    """How many projections make a bucket, and how many tables there are."""

    projections: int
    tables: int


def tables_for(vectors: int, cosine: float = COSINE, missed: float = MISSED) -> Tables:
    apart = _meeting_chance(math.sqrt(2))
    near = _meeting_chance(math.sqrt(2 - 2 * cosine))
    k = max(1, math.ceil(math.log(max(1, vectors / CROWD)) / -math.log(apart)))
    return Tables(k, math.ceil(math.log(missed) / math.log1p(-(near**k))))


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors`` (vec_id, embedding).

    Links are pairs of cosine ``cosine`` or more, in double precision, of vectors of one
    length. A vector that is missing, empty, zero or has a missing or non-finite
    component is linked with nothing; so is a row without vec_id, whose component_id is
    null. Rows that repeat are linked like any equal vectors. Other columns are ignored,
    an empty table gives an empty one.
    """
    spark = vectors.sparkSession
    kind = vectors.schema["vec_id"].dataType.simpleString()
    packed = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(
        _packed, f"vec_id {kind}, cls bigint, vector binary"
    )
    usable = packed.filter("cls IS NOT NULL AND vec_id IS NOT NULL")
    centres = _centres(usable, cosine)
    # Equal vectors are one class from here on.
    classes = usable.groupBy("cls", "vector").agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    schema = f"cls bigint, vector binary, first_id {kind}, n bigint, cell int, whole array<int>, open array<int>"
    assigned = materialize(classes.mapInArrow(_assigned(centres, cosine), schema), "vector-classes")
    cells = {
        r["cell"]: r
        for r in assigned.filter("cell IS NOT NULL")
        .groupBy("cell").agg(F.min("cls").alias("node"), F.count(F.lit(1)).alias("classes"), F.sum("n").alias("n"))
        .collect()  # at most SAMPLE / CENTRE rows
    }
    single = assigned.filter("cell IS NULL")
    links = materialize(_linked_pairs(single, single.count(), cosine), "vector-links")
    open_links = materialize(_open_links(assigned, cells, cosine), "cell-links")

    size = _lookup({c: r["n"] for c, r in cells.items()}, "bigint")
    node_of = _lookup({c: r["node"] for c, r in cells.items()}, "bigint")
    whole = assigned.select("cls", "n", "cell", F.explode("whole").alias("other")).filter(size("other").isNotNull())
    counts = (
        links.select(F.col("a").alias("cls"), F.col("n_b").alias("links"))
        .unionAll(links.select(F.col("b").alias("cls"), F.col("n_a").alias("links")))
        .unionAll(open_links.select("cls", "links"))
        .unionAll(whole.select("cls", size("other").alias("links")))
        .groupBy("cls").agg(F.sum("links").alias("links"))
    )
    # What lone vectors add to every member of a cell.
    added = {r["other"]: r["n"] for r in whole.filter("cell IS NULL").groupBy("other").agg(F.sum("n").alias("n")).collect()}
    node = F.coalesce(node_of("cell"), F.col("cls"))
    edges = (
        links.select("a", "b")
        .unionAll(open_links.filter("links > 0 AND other IS NOT NULL").select(
            F.coalesce(node_of("cell"), F.col("cls")).alias("a"), node_of("other").alias("b")))
        .unionAll(whole.select(node.alias("a"), node_of("other").alias("b")))
    )
    found = components(edges)
    in_cell = F.coalesce(size("cell") - F.col("n") + F.coalesce(_lookup(added, "bigint")("cell"), F.lit(0)), F.lit(0))
    joined = (
        assigned.select("cls", "n", "first_id", node.alias("node"), in_cell.alias("in_cell"))
        .join(counts, "cls", "left").join(found, "node", "left")
        .select(
            "cls", "first_id", F.coalesce("component", "node").alias("component"),
            (F.col("n") - 1 + F.col("in_cell") + F.coalesce("links", F.lit(0))).alias("n_links"),
        )
    )
    result = materialize(joined, "class-links")
    least = result.groupBy("component").agg(F.min("first_id").alias("component_id"))
    # A component of one class needs no look-up; others are joined by what they are few of.
    named = result.join(least, "component").select(F.col("cls").alias("c_cls"), "n_links", "component_id")
    rows = packed.withColumn("cls", F.when(F.col("vec_id").isNotNull(), F.col("cls")))
    return rows.select("vec_id", "cls").join(named, F.col("cls") == F.col("c_cls"), "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce("component_id", "vec_id").eqNullSafe(F.col("vec_id")).alias("kept"),
    )


def _lookup(values: dict[int, int], kind: str) -> Callable[[str], Column]:
    """A column's entry in a small fixed map, null where it has none."""
    if not values:
        return lambda column: F.lit(None).cast(kind)
    entries = F.create_map(*(F.lit(x) for pair in values.items() for x in pair))
    return lambda column: F.try_element_at(entries, F.col(column)).cast(kind)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each usable vector as bytes of doubles with a 64-bit digest; others without."""
    for batch in batches:
        column = batch.column("embedding")
        offsets = column.offsets.to_numpy()
        values = column.values
        numbers = values.to_numpy(zero_copy_only=False).astype("<f8") + 0.0  # no negative zero
        good = np.isfinite(numbers)
        if values.null_count:
            good &= ~np.asarray(values.is_null())
        missing = np.asarray(column.is_null())
        digests, vectors = [], []
        for k, (a, b) in enumerate(zip(offsets, offsets[1:])):
            if missing[k] or a == b or not good[a:b].all() or not numbers[a:b].any():
                digests.append(None)
                vectors.append(None)
                continue
            data = numbers[a:b].tobytes()
            digests.append(int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True))
            vectors.append(data)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array(digests, pa.int64()), pa.array(vectors, pa.binary())],
            ["vec_id", "cls", "vector"],
        )


def _units(vectors: list[bytes] | pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Unit vectors in a matrix for each length, with their places in the list."""
    raw = vectors.to_pylist() if isinstance(vectors, pa.Array) else vectors
    by_length: dict[int, list[int]] = {}
    for k, v in enumerate(raw):
        by_length.setdefault(len(v) // 8, []).append(k)
    out = {}
    for length, places in by_length.items():
        matrix = np.frombuffer(b"".join(raw[k] for k in places), "<f8").reshape(-1, length)
        matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
        out[length] = matrix / np.linalg.norm(matrix, axis=1, keepdims=True), np.array(places)
    return out


def _centres(usable: DataFrame, cosine: float) -> np.ndarray:
    """Where the distinct vectors of a bounded sample crowd: unit vectors in rows."""

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, bytes] = {}
        for batch in batches:
            kept |= dict(zip(batch.column("cls").to_pylist(), batch.column("vector").to_pylist()))
            if len(kept) > 2 * SAMPLE:
                kept = {c: kept[c] for c in sorted(kept)[:SAMPLE]}
        chosen = sorted(kept)[:SAMPLE]
        yield pa.RecordBatch.from_pydict(
            {"cls": pa.array(chosen, pa.int64()), "vector": pa.array([kept[c] for c in chosen], pa.binary())}
        )

    rows = usable.select("cls", "vector").mapInArrow(smallest, "cls bigint, vector binary")
    sample = rows.groupBy("cls").agg(F.min("vector").alias("vector")).orderBy("cls").limit(SAMPLE).collect()
    by_length = _units([bytes(r["vector"]) for r in sample])
    if not by_length:
        return np.zeros((0, 0))
    units = max((u for u, _ in by_length.values()), key=len)
    near = (units @ units.T) >= cosine
    radius = math.cos(math.acos(cosine) / 2 - _SLACK)
    left = np.ones(len(units), bool)
    degree = near.sum(axis=1)
    centres = []
    while True:
        best = int(np.argmax(np.where(left, degree, 0)))
        if not left[best] or degree[best] < CENTRE:
            break
        mean = units[near[best] & left].mean(axis=0)
        mean /= np.linalg.norm(mean)
        inside = left & (units @ mean >= radius)
        if inside.sum() >= CENTRE:
            centres.append(mean)
        else:
            inside = np.zeros(len(units), bool)
        inside[best] = True
        degree = degree - near[:, inside & left].sum(axis=1)
        left &= ~inside
    return np.array(centres).reshape(-1, units.shape[1])


def _assigned(centres: np.ndarray, cosine: float):
    """Each class with its cell, the cells it is linked with whole, and those still open."""
    angle = math.acos(cosine)
    inner = angle / 2 - _SLACK  # a member's distance from its centre at most

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            cell = np.full(n, -1)
            whole: list[list[int]] = [[] for _ in range(n)]
            open_: list[list[int]] = [[] for _ in range(n)]
            units = _units(batch.column("vector")).get(centres.shape[1]) if len(centres) else None
            if units is not None:
                matrix, places = units
                for first in range(0, len(places), 4096):
                    part = places[first : first + 4096]
                    apart = np.arccos(np.clip(matrix[first : first + 4096] @ centres.T, -1, 1))
                    own = apart.argmin(axis=1)
                    inside = apart[np.arange(len(part)), own] <= inner
                    cell[part[inside]] = own[inside]
                    apart[inside, own[inside]] = np.inf
                    for rows, out in ((apart + inner <= angle - _SLACK, whole),
                                      ((apart + inner > angle - _SLACK) & (apart - inner <= angle + _SLACK), open_)):
                        for k, c in zip(*np.nonzero(rows)):
                            out[part[k]].append(int(c))
            yield pa.RecordBatch.from_arrays(
                [batch.column("cls"), batch.column("vector").cast(pa.binary()), batch.column("first_id"), batch.column("n"),
                 pa.array(cell, pa.int32(), mask=cell < 0), pa.array(whole, pa.list_(pa.int32())),
                 pa.array(open_, pa.list_(pa.int32()))],
                ["cls", "vector", "first_id", "n", "cell", "whole", "open"],
            )

    return assign


def _linked_pairs(single: DataFrame, vectors: int, cosine: float) -> DataFrame:
    """(a, b, n_a, n_b) of linked classes outside cells, each pair once."""
    entries = single.select("cls", "vector").mapInArrow(
        _entries(tables_for(vectors, cosine)), "bucket bigint, cls bigint, signs bigint"
    )
    met = entries.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_met, _PAIR).distinct()
    def side(name: str) -> DataFrame:
        return single.select(F.col("cls").alias(name), F.col("vector").alias(f"v_{name}"), F.col("n").alias(f"n_{name}"))
    both = met.join(side("a"), "a").join(side("b"), "b")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            a, b = _units(batch.column("v_a")), _units(batch.column("v_b"))
            for length, (left, places) in a.items():
                right, others = b.get(length, (None, None))
                if right is None:
                    continue
                _, i, j = np.intersect1d(places, others, assume_unique=True, return_indices=True)
                keep[places[i]] = np.einsum("ij,ij->i", left[i], right[j]) >= cosine
            yield batch.select(["a", "b", "n_a", "n_b"]).filter(pa.array(keep))

    return both.select("a", "b", "n_a", "n_b", "v_a", "v_b").mapInArrow(exact, f"{_PAIR}, n_a bigint, n_b bigint")


def _entries(tables: Tables):
    """A row for each vector and table: the bucket and the vector's sign bits."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn: dict[int, tuple] = {}
        for batch in batches:
            ids = batch.column("cls").to_numpy()
            for length, (units, places) in _units(batch.column("vector")).items():
                if length not in drawn:
                    random = np.random.default_rng(length)
                    drawn[length] = (
                        random.standard_normal((length, tables.tables * tables.projections)),
                        random.uniform(0, WIDTH, tables.tables * tables.projections),
                        random.standard_normal((length, SIGN_BITS)),
                        random.integers(1, 1 << 62, tables.projections, np.int64) | 1,
                        random.integers(0, 1 << 62, tables.tables, np.int64),
                    )
                directions, shifts, planes, odd, salts = drawn[length]
                for first in range(0, len(places), 1024):
                    part = units[first : first + 1024]
                    cells = np.floor((part @ directions + shifts) / WIDTH).astype(np.int64)
                    with np.errstate(over="ignore"):
                        keys = cells.reshape(len(part), tables.tables, -1) @ odd
                        keys = (keys ^ (keys >> 29)) * np.int64(0x3F58476D1CE4E5B9) + salts
                        keys ^= keys >> 32
                    bits = (part @ planes > 0).astype(np.uint8)
                    signs = np.packbits(bits, axis=1).view(np.int64)[:, 0]
                    own = ids[places[first : first + 1024]]
                    yield pa.RecordBatch.from_pydict({
                        "bucket": keys.ravel(),
                        "cls": np.repeat(own, tables.tables),
                        "signs": np.repeat(signs, tables.tables),
                    })

    return hashed


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs within a bucket whose sign bits agree well enough; buckets come in order."""
    bucket, ids, signs = (np.zeros(0, np.int64) for _ in range(3))

    def pairs(starts: np.ndarray, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
        # Distances between places of a bucket, one after the other over all buckets.
        sizes = ends - starts
        distance = 1
        while len(sizes) and sizes.max() > distance:
            open_ = sizes > distance
            starts, ends, sizes = starts[open_], ends[open_], sizes[open_]
            counts = sizes - distance
            left = np.arange(counts.sum()) + np.repeat(starts - (np.cumsum(counts) - counts), counts)
            right = left + distance
            near = np.bitwise_count((signs[left] ^ signs[right]).view(np.uint64)) <= MOST_DIFFERENT
            a, b = ids[left[near]], ids[right[near]]
            if len(a):
                yield pa.RecordBatch.from_pydict({"a": np.minimum(a, b), "b": np.maximum(a, b)})
            distance += 1

    for batch in batches:
        columns = [batch.column(c).to_numpy() for c in ("bucket", "cls", "signs")]
        bucket, ids, signs = (np.concatenate(p) for p in zip((bucket, ids, signs), columns))
        borders = np.flatnonzero(np.diff(bucket)) + 1
        if len(borders):  # the last bucket may go on
            starts = np.append(0, borders[:-1])
            yield from pairs(starts, borders)
            bucket, ids, signs = (x[borders[-1] :] for x in (bucket, ids, signs))
    yield from pairs(np.array([0]), np.array([len(ids)]))


def _open_links(assigned: DataFrame, cells: dict[int, dict], cosine: float) -> DataFrame:
    """Links between cells' members and vectors for which the angles leave it open.

    Rows (cls, cell, other, links): for a vector, its links with members of ``other``;
    for a member, its links with lone vectors (``other`` null). Both sides come in
    blocks, and each block of vectors meets each block of the cell's members.
    """
    known = _lookup({c: 1 for c in cells}, "int")
    asked = assigned.select("cls", "vector", "n", "cell", F.explode("open").alias("other")).filter(
        known("other").isNotNull()
    )
    # A cell's vectors are few kinds (at most SAMPLE / CENTRE counts).
    asking = {r["other"]: r["count"] for r in asked.groupBy("other").count().collect()}
    members = assigned.filter("cell IS NOT NULL").withColumn("other", F.col("cell"))

    def blocks(frame: DataFrame, sizes: dict[int, int], name: str) -> DataFrame:
        parts = _lookup({c: -(-n // BLOCK) for c, n in sizes.items()}, "int")("other")
        block = F.pmod(F.xxhash64("cls"), parts)
        return frame.filter(parts.isNotNull()).groupBy("other", block.alias(f"block_{name}")).agg(
            F.collect_list(F.struct("cls", "vector", "n", "cell")).alias(name)
        )

    met = blocks(asked, asking, "asked").join(
        blocks(members, {c: cells[c]["classes"] for c in asking}, "members"), "other"
    )
    item = "cls bigint, cell int, other int, links bigint"

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                cell = batch.column("other")[k].as_py()
                asked, members = (batch.column(c)[k].values for c in ("asked", "members"))
                (left, _), = _units(asked.field("vector")).values()
                (right, _), = _units(members.field("vector")).values()
                hit = left @ right.T >= cosine
                n_asked, n_members = asked.field("n").to_numpy(), members.field("n").to_numpy()
                lone = np.asarray(asked.field("cell").is_null())
                to_asked, to_members = hit @ n_members, n_asked[lone] @ hit[lone]
                one, two = to_asked > 0, to_members > 0
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([asked.field("cls").filter(pa.array(one)), members.field("cls").filter(pa.array(two))]),
                        pa.concat_arrays([asked.field("cell").filter(pa.array(one)), members.field("cell").filter(pa.array(two))]),
                        pa.array([cell] * int(one.sum()) + [None] * int(two.sum()), pa.int32()),
                        pa.array(np.concatenate([to_asked[one], to_members[two]]), pa.int64()),
                    ],
                    ["cls", "cell", "other", "links"],
                )

    return met.select("other", "asked", "members").mapInArrow(compare, item)
