"""Quality scores learned from preference pairs (Bradley-Terry).

Of two documents of different label the better one is preferred with probability
sigmoid(s(better) - s(worse)), s a weighted sum of text features. The weights minimise
the logistic loss of feature differences by Newton steps, each one Spark job over the
labelled rows' features. A quantile of the learned scores then becomes the threshold,
and scores are mapped to 0..1 so that the threshold lies at :data:`CUT`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolweave.llm.common import hashed_words, remainder, text_blocks, text_bytes, whole_text
from poolweave.session import materialize

CUT = 0.7  # the score from which a document counts as good
PAIRS_PER_ROW = 8  # preference pairs that a row of the rarer label takes part in
NEWTON_STEPS = 12
RIDGE = 1e-3
CHUNK = 4096  # labelled rows whose pairs are formed together

FEATURES = (
    "log_words", "word_length", "letters", "capitals", "digits", "symbols", "bars",
    "exclamations", "stops", "commas", "line_breaks", "repeated_words", "distinct_words",
    "symbol_words", "empty",
)

_KINDS = np.zeros(256, np.int64)
for _kind, _bytes in enumerate(
    (b"abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256)), b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
     b"0123456789", b"#$%&*+=@\\^_`~<>{}[]", b"|", b"!?", b".:;", b",", b"\n\r"), 1
):
    _KINDS[list(_bytes)] = _kind
_N_KINDS = int(_KINDS.max()) + 1


def features_of(texts: pa.Array) -> np.ndarray:
    """One row of features per text."""
    data, borders = text_bytes(texts)
    n = len(borders) - 1
    owner = np.repeat(np.arange(n), np.diff(borders))
    kinds = np.bincount(owner * _N_KINDS + _KINDS[data], minlength=n * _N_KINDS)
    kinds = kinds.reshape(n, _N_KINDS).astype(float)
    words = hashed_words(data, borders)
    counts = np.diff(words.first)
    text_of_word = np.repeat(np.arange(n), counts)
    again = np.zeros(len(words.hashes), bool)
    again[1:] = (words.hashes[1:] == words.hashes[:-1]) & (text_of_word[1:] == text_of_word[:-1])
    marked = np.zeros(len(words.hashes), bool)
    if len(marked):
        last = data[words.starts + words.lengths - 1]
        marked = (_KINDS[last] >= 4) & (_KINDS[last] <= 6)
    per_text = lambda flag: np.bincount(text_of_word, flag, n)
    order = np.lexsort((words.hashes, text_of_word))
    hashes, owners = words.hashes[order], text_of_word[order]
    new = np.ones(len(order), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    distinct = np.bincount(owners, new, n)
    size = np.maximum(np.diff(borders), 1)
    some = np.maximum(counts, 1)
    return np.column_stack(
        [
            np.log1p(counts),
            np.minimum(kinds[:, 1:3].sum(1) / some, 40) / 10,
            kinds[:, 1:3].sum(1) / size,
            kinds[:, 2] / size,
            kinds[:, 3] / size,
            kinds[:, 4] / size,
            kinds[:, 5] / size,
            kinds[:, 6] / size,
            kinds[:, 7] / size,
            kinds[:, 8] / size,
            kinds[:, 9] / size,
            per_text(again) / some,
            # words differ less the longer a text is: Herdan's ratio of logarithms
            np.log1p(distinct) / np.log1p(some),
            per_text(marked) / some,
            (counts == 0).astype(float),
        ]
    )


def with_features(docs: DataFrame) -> DataFrame:
    """doc_id and the features of every row (doc_id, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, "text"):
            values = features_of(block.column("text"))
            flat = pa.array(values.ravel(), pa.float64())
            lists = pa.ListArray.from_arrays(np.arange(len(values) + 1, dtype=np.int32) * len(FEATURES), flat)
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), lists], ["doc_id", "features"])

    whole = docs.select("doc_id", whole_text().alias("text"))
    return whole.mapInArrow(measure, f"doc_id {kind}, features array<double>")


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    trained: bool


def _labelled(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """Features with a label, one row per document; conflicting labels count as bad."""
    one = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    learn = measured.filter(remainder("doc_id", 4) != 2).dropDuplicates(["doc_id"])
    return learn.join(one, "doc_id").select("doc_id", "features", "quality")


def _sums(rows: DataFrame, make, width: int) -> np.ndarray:
    """The sum over all chunks of a table of ``make(features, labels)``."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            x = np.asarray(batch.column("features").flatten()).reshape(-1, len(FEATURES))
            y = np.asarray(batch.column("quality"))
            for k in range(0, len(y), CHUNK):
                total += make(x[k : k + CHUNK], y[k : k + CHUNK])
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(width), pa.int32()), pa.array(total)], ["place", "part"]
        )

    parts = rows.select("features", "quality").mapInArrow(partial, "place int, part double")
    out = np.zeros(width)
    for place, total in parts.groupBy("place").agg(F.sum("part")).collect():  # width rows
        out[place] = total
    return out


def _pairs(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of preferred and other rows: the rarer label's rows meet a few others."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return good[:0], bad[:0]
    rarer, other = (bad, good) if len(bad) <= len(good) else (good, bad)
    k = min(PAIRS_PER_ROW, len(other))
    a = np.repeat(rarer, k)
    b = other[np.arange(len(a)) % len(other)]
    return (b, a) if rarer is bad else (a, b)


def train(measured: DataFrame, labels: DataFrame) -> Model:
    """Learn from the labelled rows that are not held out.

    Without rows of both labels nothing is learned, and every score is 0.5.
    """
    d = len(FEATURES)
    spark = measured.sparkSession
    few = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)
    rows = materialize(
        _labelled(measured, labels).repartition(few, F.xxhash64("doc_id")).sortWithinPartitions("doc_id"),
        "labelled-features",
    )
    moments = _sums(
        rows,
        lambda x, y: np.concatenate([[len(y), (y == 0).sum()], x.sum(0), (x * x).sum(0)]),
        2 + 2 * d,
    )
    n, n_bad = moments[:2]
    if not n or not n_bad or n == n_bad:
        return Model(np.zeros(d), np.ones(d), np.zeros(d), 0.0, False)
    mean = moments[2 : 2 + d] / n
    scale = np.sqrt(np.maximum(moments[2 + d :] / n - mean**2, 0)) + 1e-6
    weights = np.zeros(d)
    for _ in range(NEWTON_STEPS):

        def loss_terms(x, y, w=weights):
            better, worse = _pairs(y)
            diff = (x[better] - x[worse]) / scale
            p = 1 / (1 + np.exp(np.clip(diff @ w, -60, 60)))  # of the worse one winning
            hessian = (diff * (p * (1 - p))[:, None]).T @ diff
            return np.concatenate([[len(p)], diff.T @ p, hessian.ravel()])

        terms = _sums(rows, loss_terms, 1 + d + d * d)
        pairs = max(terms[0], 1)
        gradient = terms[1 : 1 + d] / pairs - RIDGE * weights
        hessian = terms[1 + d :].reshape(d, d) / pairs + RIDGE * np.eye(d)
        step = np.linalg.solve(hessian, gradient)
        weights = weights + step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
        if np.abs(gradient).max() < 1e-4:
            break
    threshold = _quantile(rows, mean, scale, weights, n_bad / n)
    return Model(mean, scale, weights, threshold, True)


def _quantile(rows: DataFrame, mean, scale, weights, share: float, rounds: int = 3) -> float:
    """Middle of the widest gap around the quantile of the learned scores.

    The score below which ``share`` of the rows lie, found by histograms refined a few
    times, one job each.
    """
    score = lambda x: ((x - mean) / scale) @ weights
    low, high, below, bins = -1e4, 1e4, 0.0, 2000
    total = None
    for _ in range(rounds):
        edges = np.linspace(low, high, bins + 1)
        counts = _sums(rows, lambda x, y, e=edges: np.histogram(score(x), e)[0], bins)
        total = counts.sum() if total is None else total
        reached = below + np.cumsum(counts)
        k = int(np.searchsorted(reached, share * total))
        k = min(k, bins - 1)
        below = reached[k] - counts[k]
        low, high = edges[k], edges[k + 1]
        # empty bins after the quantile belong to the gap: stop in the middle of it
        after = np.flatnonzero(counts[k + 1 :])
        if len(after) and after[0] > 2:
            return float((edges[k + 1] + edges[k + 1 + after[0]]) / 2)
    return float((low + high) / 2)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and trained of every row of ``docs`` (doc_id, text).

    A null or empty text has the features of the empty text and is scored by them.
    Rows that repeat, and rows without doc_id (never held out), are scored like any
    other. ``labels`` (doc_id, quality): rows with a null are ignored. Other columns of
    both tables are ignored. Texts of any length are measured whole; an empty table gives
    an empty one, empty labels a score of 0.5 for all.
    """
    measured = materialize(with_features(docs), "quality-features")
    model = train(measured, labels)
    if not model.trained:
        score = F.lit(0.5)
    else:
        weights = [w / s for w, s in zip(model.weights.tolist(), model.scale.tolist())]
        offset = math.log(CUT / (1 - CUT)) - model.threshold - float(model.mean @ np.array(weights))
        margin = sum((F.get("features", F.lit(k)) * w for k, w in enumerate(weights)), F.lit(offset))
        score = 1 / (1 + F.exp(-F.greatest(F.lit(-40.0), F.least(F.lit(40.0), margin))))
    return measured.select(
        "doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), score.alias("score")
    ).withColumns({"predicted": (F.col("score") >= CUT).cast("int"), "trained": F.lit(model.trained)})
