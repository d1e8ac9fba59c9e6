"""Language identification in two levels: family first, then the language within it.

Texts become hashed counts of letter n-grams. One linear support vector machine per
family tells it from the rest; within the family that wins, one machine per pair of its
languages votes. Each machine is trained in a task of its own, on a bounded sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from poolweave.llm.common import LOWER, remainder, text_blocks, text_bytes, whole_text
from poolweave.session import materialize

BUCKETS = 4096
SAMPLE_PER_LANGUAGE = 600  # expected number of training rows of a language, at most
SAMPLE_CHARS = 20_000  # training texts above this length are left to the others
EPOCHS = 40
UNKNOWN = "und"

#: Families of common languages by ISO 639-1 code. A language that is
#: not listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt rm ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "celtic": "br cy ga gd",
    "baltic": "lt lv",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tt uz",
    "indo-aryan": "bn gu hi mr ne pa ur",
    "semitic": "am ar he mt",
}
_FAMILY_OF = {code: name for name, codes in FAMILIES.items() for code in codes.split()}

#: Bytes as letters in lower case, everything else as a space.
_LETTERS = np.full(256, 32, np.uint32)
for _b in [*range(65, 91), *range(97, 123), *range(128, 256)]:
    _LETTERS[_b] = LOWER[_b]


def family_of(language: str) -> str:
    return _FAMILY_OF.get(language, language)


def ngram_counts(texts: pa.Array) -> np.ndarray:
    """Per text the square roots of its n-gram counts by bucket, of unit length.

    N-grams are one to four bytes; runs of other bytes count as one space.
    """
    data, borders = text_bytes(texts)
    out = np.zeros((len(borders) - 1, BUCKETS), np.float32)
    for k in range(len(out)):
        own = _LETTERS[data[borders[k] : borders[k + 1]]]
        if len(own) > 1:
            own = own[np.append(True, (own[1:] != 32) | (own[:-1] != 32))]
        own = np.concatenate([[np.uint32(32)], own, [np.uint32(32)]])
        counts = np.zeros(BUCKETS, np.int64)
        gram = own
        for n in range(2, 5):
            gram = gram[:-1] * np.uint32(0x01000193) ^ own[n - 1 :]
            code = gram * np.uint32(2654435761) >> np.uint32(20)
            counts += np.bincount(code, minlength=BUCKETS)
        row = np.sqrt(counts, dtype=np.float32)
        out[k] = row / max(float(np.sqrt((row * row).sum())), 1e-9)
    return out


@dataclass
class Machines:
    """Linear machines: of each family against the rest, of each pair of languages."""

    families: dict[str, np.ndarray]
    pairs: dict[tuple[str, str], np.ndarray]
    languages: list[str]


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights and bias of a linear SVM: dual coordinate ascent, squared hinge loss."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    cost = 10.0 * weight
    w = np.zeros(x.shape[1])
    alpha = np.zeros(len(x))
    norms = (x * x).sum(1) + 0.5 / cost
    order = np.arange(len(x))
    mixer = np.random.default_rng(7)
    for _ in range(EPOCHS):
        mixer.shuffle(order)
        moved = 0.0
        for i in order:
            slack = y[i] * float(x[i] @ w) - 1 + alpha[i] * 0.5 / cost[i]
            new = max(0.0, alpha[i] - slack / norms[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


def train(docs: DataFrame) -> Machines:
    """Learn from rows (doc_id, text, lang) with a language that are not held out.

    The sample takes every row of a language up to :data:`SAMPLE_PER_LANGUAGE`, above
    that the share of rows that is expected to give this number, by a hash of the id.
    """
    spark = docs.sparkSession
    usable = (
        docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
        .filter((remainder("doc_id", 5) != 0) & F.col("text").rlike(r"\p{L}"))
    )
    short = F.length("text") <= SAMPLE_CHARS
    found = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("all"), F.count_if(short).alias("short")).collect()
    # Long texts are left out of the sample only where their language has shorter ones.
    counts = {r["lang"]: r["short"] or r["all"] for r in found}
    languages = sorted(counts)
    usable = usable.filter(short | F.col("lang").isin([r["lang"] for r in found if not r["short"]]))
    if not languages:
        return Machines({}, {}, [])
    share = F.lit(0)
    for lang in languages:
        some = int(min(1.0, SAMPLE_PER_LANGUAGE / counts[lang]) * 1_000_000)
        share = F.when(F.col("lang") == lang, some).otherwise(share)
    chosen = usable.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share)
    sample = materialize(chosen.select("doc_id", "text", "lang"), "language-sample")
    families = sorted({family_of(x) for x in languages})
    tasks = [("family", name, "") for name in families[: len(families) if len(families) > 2 else 1]]
    if len(families) == 1:
        tasks = []
    members = {f: [x for x in languages if family_of(x) == f] for f in families}
    tasks += [("pair", *p) for own in members.values() for p in combinations(own, 2)]
    if not tasks:
        return Machines({f: np.append(np.zeros(BUCKETS), 1.0) for f in families}, {}, languages)
    todo = spark.createDataFrame(tasks, "level string, one string, other string")
    family = F.lit(None).cast("string")
    for lang in languages:
        family = F.when(F.col("lang") == lang, family_of(lang)).otherwise(family)
    rows = sample.withColumn("family", family)
    # A row goes to the machines that learn from it; every machine's rows are bounded.
    wanted = (F.col("level") == "family") | F.col("lang").isin(F.col("one"), F.col("other"))
    dealt = rows.join(F.broadcast(todo), wanted)

    def fit(keys: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        level, one, _ = keys
        rows = rows.drop_duplicates("doc_id").sort_values("doc_id")
        x = ngram_counts(pa.array(rows["text"], pa.string()))
        y = np.where((rows["family"] if level == "family" else rows["lang"]) == one, 1.0, -1.0)
        share = np.where(y > 0, (y > 0).mean(), (y < 0).mean())
        return pd.DataFrame({"level": [level], "one": [one], "other": [keys[2]], "w": [_fit(x, y, 0.5 / share)]})

    schema = "level string, one string, other string, w array<double>"
    fitted = dealt.groupBy("level", "one", "other").applyInPandas(fit, schema).collect()
    of_family = {r["one"]: np.array(r["w"]) for r in fitted if r["level"] == "family"}
    if len(families) == 2:
        of_family[families[1]] = -of_family[families[0]]
    if len(families) == 1:
        of_family = {families[0]: np.append(np.zeros(BUCKETS), 1.0)}
    pairs = {(r["one"], r["other"]): np.array(r["w"]) for r in fitted if r["level"] == "pair"}
    return Machines(of_family, pairs, languages)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(4 * x, -60, 60)))


def predict(x: np.ndarray, machines: Machines) -> tuple[np.ndarray, np.ndarray]:
    """The language of each row, and how sure the two levels are together."""
    names = sorted(machines.families)
    matrix = np.stack([machines.families[f] for f in names])
    margins = x @ matrix[:, :-1].T.astype(np.float32) + matrix[:, -1]
    best = margins.argmax(1)
    sure = _sigmoid(margins[np.arange(len(x)), best])
    languages = np.empty(len(x), object)
    for k, name in enumerate(names):
        rows = np.flatnonzero(best == k)
        own = [x for x in machines.languages if family_of(x) == name]
        votes = np.zeros((len(rows), len(own)))
        belief = np.ones((len(rows), len(own)))
        for a, b in combinations(range(len(own)), 2):
            w = machines.pairs[own[a], own[b]]
            p = _sigmoid(x[rows] @ w[:-1].astype(np.float32) + w[-1])
            votes[:, a] += p >= 0.5
            votes[:, b] += p < 0.5
            belief[:, a] = np.minimum(belief[:, a], p)
            belief[:, b] = np.minimum(belief[:, b], 1 - p)
        winner = (votes + belief).argmax(1)
        languages[rows] = np.array(own, object)[winner]
        sure[rows] *= belief[np.arange(len(rows)), winner]
    return languages, sure


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of ``docs`` (doc_id, text, lang).

    A text that is null or has no letter is ``und`` with score 0, and so is every text
    where there is nothing to learn from. Rows that repeat, and rows without doc_id (never
    held out, never learned from), are judged like any other; other columns are ignored.
    """
    docs = docs.select("doc_id", F.col("text").cast("string"), F.col("lang").cast("string"))
    machines = train(docs)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, "text"):
            n = block.num_rows
            names, sure = np.full(n, UNKNOWN, object), np.zeros(n)
            rows = np.flatnonzero(np.asarray(block.column("lettered")))
            for k in range(0, len(rows) if machines.languages else 0, 256):
                some = rows[k : k + 256]
                x = ngram_counts(block.column("text").take(pa.array(some)))
                names[some], sure[some] = predict(x, machines)
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), block.column("held_out"), pa.array(names, pa.string()), pa.array(sure)],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered")
    held_out = (remainder("doc_id", 5) == 0).alias("held_out")
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("held_out", T.BooleanType()),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    whole = docs.select("doc_id", held_out, lettered, whole_text().alias("text"))
    return whole.mapInArrow(judge, schema)
