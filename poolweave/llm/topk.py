"""Exact top-k search by distributed selection in score histograms.

All queries are scored against all vectors, block by block, several times over. The
vectors are written once and stay where they are read; queries come to them in groups of
a bounded size, and each group goes through all rounds. Each round counts every query's scores in the bins of its present interval; the bin with the
k-th highest score becomes the next interval, until a bin is a single score. A last
round keeps what reaches that score, the smallest ids first among equal ones.

A block reports only the bins from its own k-th best score up: the k-th best of all is
never lower, so the counts above it are complete. That bounds the rows by k for each
query and block, and no block's scores are kept between rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from poolweave.session import materialize, scratch_path

SCALE = 256
BLOCK = 2048  # vectors of a block, of queries and of candidates
BINS = 1024
GROUP = 8  # query blocks that are sent to all tasks at once: some 8 MB at 64 components
EXACT = float(1 << 53)  # up to here products of doubles are exact whole numbers
_LOWEST, _HIGHEST = -(2**63), 2**63 - 1

_BLOCK_COLUMNS = "block long, ids binary, matrix binary, width int, n int, norm double"


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id and the components as whole doubles, one row per vec_id.

    Rows without id, without vector, or with a null or non-finite component are left
    out. Of several vectors of one id the smallest in component order counts.
    """
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")))
    usable = embeddings.filter(F.col("vec_id").isNotNull() & x.isNotNull() & finite)
    most = F.lit(1e300)  # keeps 256 x finite
    whole = F.transform(x, lambda v: _floor(F.greatest(-most, F.least(most, v.cast("double") * SCALE))))
    return (
        usable.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("vec"))
        .groupBy("vec_id")
        .agg(F.min("vec").alias("vec"))
    )


def _floor(x):
    """floor of a double as a double; beyond 2^52 every double is whole."""
    return F.when(F.abs(x) < float(1 << 52), F.floor(x).cast("double")).otherwise(x)


def _blocks(vectors: DataFrame) -> DataFrame:
    """Rows of up to :data:`BLOCK` vectors with their ids as bytes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for k in range(0, batch.num_rows, BLOCK):
                part = batch.slice(k, BLOCK)
                lists = part.column("vec")
                counts = np.diff(np.asarray(lists.offsets))
                width = int(counts.max())
                matrix = np.zeros((len(part), width))  # shorter vectors end in zeros
                matrix[np.arange(width) < counts[:, None]] = np.asarray(lists.flatten())
                ids = np.asarray(part.column("vec_id"))
                norm = float(np.sqrt((matrix * matrix).sum(1)).max())
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": [number],
                        "ids": [ids.tobytes()],
                        "matrix": [matrix.tobytes()],
                        "width": pa.array([width], pa.int32()),
                        "n": pa.array([len(part)], pa.int32()),
                        "norm": [norm],
                    }
                )
                number += 1

    return vectors.mapInArrow(pack, _BLOCK_COLUMNS)


def _matrix(data: bytes, n: int, width: int) -> np.ndarray:
    return np.frombuffer(data, np.float64).reshape(n, width)


def scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products as whole numbers; beyond 64 bits the nearest 64-bit number."""
    width = min(queries.shape[1], candidates.shape[1])
    a, b = queries[:, :width], candidates[:, :width]
    if width == 0:
        return np.zeros((len(queries), len(candidates)), np.int64)
    if np.abs(a).max() * np.abs(b).max() * width < EXACT:
        return (a @ b.T).astype(np.int64)
    exact = [[int(v) for v in row] for row in a], [[int(v) for v in row] for row in b]
    product = lambda x, y: min(max(sum(map(int.__mul__, x, y)), _LOWEST), _HIGHEST)
    return np.array([[product(x, y) for y in exact[1]] for x in exact[0]], np.int64)


def top_k(embeddings: DataFrame, k: int = 5, query_every: int = 50) -> DataFrame:
    """query_id, rank, vec_id, score of the k best other vectors of every query.

    Queries are the vectors whose id is divisible by ``query_every``; ties go to the
    smaller id. A query with fewer than k others gets all of them, one with none no row.
    A vector that is shorter than another is taken to end in zeros. See
    :func:`whole_vectors` for nulls and repeated ids; other columns are ignored.
    """
    spark = embeddings.sparkSession
    vectors = whole_vectors(embeddings)
    candidates = materialize(_blocks(vectors), "candidate-blocks")
    is_query = F.pmod("vec_id", F.lit(query_every)) == 0
    queries = materialize(_blocks(vectors.filter(is_query)), "query-blocks")
    numbers = sorted(r["block"] for r in queries.select("block").collect())  # one per 2048 queries
    schema = "query_id long, rank int, vec_id long, score long"
    if not numbers:
        return spark.createDataFrame([], schema)
    top = candidates.agg(F.max("norm")).first()[0]
    reach = int(min(top * top + 1, 2.0**62))
    path = scratch_path(spark, "top-k")
    for first in range(0, len(numbers), GROUP):
        group = queries.filter(F.col("block").isin(numbers[first : first + GROUP]))
        _top_of_group(candidates, group, k, reach).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _top_of_group(candidates: DataFrame, group: DataFrame, k: int, reach: int) -> DataFrame:
    """The k best of at most :data:`GROUP` blocks of queries, which every task holds."""
    spark = candidates.sparkSession
    held = [
        (np.frombuffer(r["ids"], np.int64), _matrix(bytes(r["matrix"]), r["n"], r["width"]))
        for r in group.select("ids", "matrix", "n", "width").collect()
    ]
    asked = spark.sparkContext.broadcast(held)
    low, high = -reach, reach + 1
    levels, width = [], high - low
    while width > 1:
        width = -(-width // BINS)
        levels.append(width)
    found, intervals = None, None
    for level, span in zip(levels, [high - low, *levels]):
        work = _counting(asked, intervals, k, level, span, low)
        counted = candidates.mapInArrow(work, "query_id long, bin long, n long")
        found = _kth_bin(counted, k, found)
        place = {r["query_id"]: (r["start"], r["above"]) for r in found.collect()}  # one for each query of the group
        found = spark.createDataFrame([(q, *v) for q, v in place.items()], "query_id long, start long, above long")
        intervals = spark.sparkContext.broadcast(
            [np.array([place.get(i, (_HIGHEST, 0)) for i in ids.tolist()], np.int64).reshape(-1, 2) for ids, _ in held]
        )
    kept = candidates.mapInArrow(_keeping(asked, intervals, k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _kth_bin(counted: DataFrame, k: int, before: DataFrame | None) -> DataFrame:
    """For each query the interval of the k-th best score and how many lie above it.

    A query with fewer than k scores keeps its lowest bin.
    """
    total = counted.groupBy("query_id", "bin").agg(F.sum("n").alias("n"))
    down = Window.partitionBy("query_id").orderBy(F.desc("bin"))
    if before is None:
        above = F.lit(0).cast("long")
        joined = total.withColumn("above", above)
    else:
        joined = total.join(before.select("query_id", "above"), "query_id")
    reached = joined.withColumn("upto", F.col("above") + F.sum("n").over(down)).withColumn(
        "place", F.row_number().over(down)
    )
    last = Window.partitionBy("query_id")
    chosen = reached.withColumn(
        "chosen", F.coalesce(F.min(F.when(F.col("upto") >= k, F.col("place"))).over(last), F.max("place").over(last))
    ).filter(F.col("place") == F.col("chosen"))
    return chosen.select(
        "query_id", F.col("bin").alias("start"), (F.col("upto") - F.col("n")).alias("above")
    )


def _meetings(batches: Iterator[pa.RecordBatch], asked, intervals):
    """Ids of a query block and of a block of vectors, their scores, which pairs are one
    vector with itself, and the starts and counts of the queries' intervals."""
    for batch in batches:
        for row in range(batch.num_rows):
            get = lambda name: batch.column(name)[row].as_py()
            ids, matrix = np.frombuffer(get("ids"), np.int64), _matrix(get("matrix"), get("n"), get("width"))
            for place, (q_ids, queries) in enumerate(asked.value):
                starts, above = intervals.value[place].T if intervals is not None else (None, None)
                yield q_ids, ids, scores(queries, matrix), q_ids[:, None] == ids[None, :], starts, above


def _counting(asked, intervals, k: int, level: int, span: int, low: int):
    """Work that counts scores by bins of ``level``, from the block's k-th best up.

    ``span`` is the width of the intervals of the round before.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for q_ids, _, s, own, starts, _ in _meetings(batches, asked, intervals):
            inside = ~own
            if starts is not None:
                # scores above the interval are counted already
                inside &= (s >= starts[:, None]) & (s - starts[:, None] < span)
            s = np.where(inside, s, _LOWEST)
            if s.shape[1] > k:
                best = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k :]
                floor = best.min(1)
            else:
                floor = np.full(len(s), _LOWEST)
            origin = np.full(len(s), low) if starts is None else starts
            floor_bin = np.where(floor == _LOWEST, 0, (floor - origin) // level)
            least = np.where(floor == _LOWEST, _LOWEST + 1, origin + floor_bin * level)
            q, c = np.nonzero(s >= least[:, None])
            bins = (s[q, c] - origin[q]) // level
            keys, n = np.unique(np.stack([q, bins]), axis=1, return_counts=True)
            yield pa.RecordBatch.from_pydict(
                {"query_id": q_ids[keys[0]], "bin": origin[keys[0]] + keys[1] * level, "n": n}
            )

    return work


def _keeping(asked, intervals, k: int):
    """Work that keeps scores above the k-th, and of those equal to it the first ids."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for q_ids, ids, s, own, starts, above in _meetings(batches, asked, intervals):
            s = np.where(own, _LOWEST, s)
            q, c = np.nonzero((s > starts[:, None]) & ~own)
            eq, ec = np.nonzero((s == starts[:, None]) & ~own)
            order = np.lexsort((ids[ec], eq))
            eq, ec = eq[order], ec[order]
            rank = np.arange(len(eq)) - np.searchsorted(eq, eq)
            some = rank < k - above[eq]
            q, c = np.append(q, eq[some]), np.append(c, ec[some])
            yield pa.RecordBatch.from_pydict({"query_id": q_ids[q], "vec_id": ids[c], "score": s[q, c]})

    return work
