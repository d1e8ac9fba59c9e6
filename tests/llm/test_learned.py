"""Quality and language: held-out accuracy, and that nothing leaks in."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from poolweave.llm import language, quality
from poolweave.llm.common import remainder

from .conftest import sentence

TABLES = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{TABLES}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{TABLES}/labels.parquet")


def test_quality_of_held_out_documents(documents, labels):
    scored = quality.score_documents(documents, labels).join(labels, "doc_id")
    rows = scored.filter("held_out").collect()
    assert len(rows) > 50
    assert np.mean([r.predicted == r.quality for r in rows]) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.98


def test_held_out_labels_are_not_learned(documents, labels):
    held = remainder("doc_id", 4) == 2
    forged = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    sample = documents.limit(300)
    a = {r.doc_id: r.score for r in quality.score_documents(sample, labels).collect()}
    b = {r.doc_id: r.score for r in quality.score_documents(sample, forged).collect()}
    assert a == b


def test_pairs_prefer_the_better_row():
    y = np.array([1, 0, 1, 1, 0, 1])
    better, worse = quality._pairs(y)
    assert (y[better] == 1).all() and (y[worse] == 0).all()
    assert len(better) == 2 * 4  # each of the rarer label meets all of the other here
    assert len(quality._pairs(np.ones(5))[0]) == 0


def test_quality_of_awkward_rows(spark, awkward, awkward_rows, nothing, labels):
    no_labels = spark.createDataFrame([], "doc_id long, quality int")
    rows = quality.score_documents(awkward, no_labels).collect()
    assert len(rows) == len(awkward_rows)
    assert {(r.score, r.predicted, r.trained) for r in rows} == {(0.5, 0, False)}
    some = [(1, 1), (2, 0), (6, 1), (7, None), (None, 1), (8, 0), (1, 1), (9, 0), (10, 1), (5, 0)]
    few = spark.createDataFrame(some, "doc_id long, quality int").withColumn("features", F.lit("clash"))
    rows = quality.score_documents(awkward, few).collect()
    assert len(rows) == len(awkward_rows) and all(0 <= r.score <= 1 for r in rows)
    by_text = {}
    for r in rows:
        by_text.setdefault(next(t for k, t, *_ in awkward_rows if k == r.doc_id) or "", set()).add(r.score)
    assert all(len(s) == 1 for s in by_text.values())  # the id is no input
    assert all(not r.held_out for r in rows if r.doc_id is None)
    assert quality.score_documents(nothing, labels).count() == 0


def test_language_of_held_out_documents(documents):
    rows = language.identify(documents).filter("held_out").join(documents.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) > 100
    assert np.mean([r.lang_pred == r.lang for r in rows]) >= 0.98


def test_language_learns_no_held_out_row(documents):
    held = remainder("doc_id", 5) == 0
    forged = documents.withColumn("lang", F.when(held, "xx").otherwise(F.col("lang")))
    a = {r.doc_id: r.lang_pred for r in language.identify(documents).collect()}
    b = {r.doc_id: r.lang_pred for r in language.identify(forged).collect()}
    assert a == b and "xx" not in b.values()


def test_families_and_pairs():
    """Three families, one with three languages: the levels decide one after the other."""
    letters = {"de": "abcd", "nl": "abce", "en": "abcf", "fr": "ghij", "ru": "klmn"}
    chosen = random.Random(1)
    make = lambda lang, n: " ".join("".join(chosen.choices(letters[lang], k=5)) for _ in range(n))
    texts = [(lang, make(lang, 40)) for lang in letters for _ in range(30)]
    x = language.ngram_counts(pa.array([t for _, t in texts]))
    names = np.array([lang for lang, _ in texts])
    family = np.array([language.family_of(lang) for lang in names])
    fit = lambda hit, rows: language._fit(x[rows], np.where(hit[rows], 1.0, -1.0), np.ones(rows.sum()))
    every = np.ones(len(x), bool)
    machines = language.Machines(
        {f: fit(family == f, every) for f in set(family)},
        {(a, b): fit(names == a, (names == a) | (names == b)) for a, b in (("de", "en"), ("de", "nl"), ("en", "nl"))},
        sorted(letters),
    )
    fresh = [(lang, make(lang, 40)) for lang in letters for _ in range(10)]
    got, sure = language.predict(language.ngram_counts(pa.array([t for _, t in fresh])), machines)
    assert np.mean(got == np.array([lang for lang, _ in fresh])) > 0.95
    assert ((sure >= 0) & (sure <= 1)).all()


def test_language_of_awkward_rows(spark, awkward, awkward_rows, nothing):
    rows = language.identify(awkward).collect()
    assert len(rows) == len(awkward_rows)
    for r in rows:
        text = next(t for k, t, *_ in awkward_rows if k == r.doc_id)
        lettered = any(c.isalpha() for c in text or "")
        assert (r.lang_pred != "und") == lettered and 0 <= r.score <= 1
    assert language.identify(nothing).count() == 0
    unlabelled = awkward.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify(unlabelled).collect()} == {"und"}
    assert sentence(1, 3) == sentence(1, 3)


def test_a_language_of_long_texts_only_is_learned(spark, make_docs, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_CHARS", 300)
    words = {"en": "the of and with this that from have", "xx": "zor vek mul tasi grun pelo wixi yuta"}
    texts = [
        (k, " ".join(words[x].split() * (4 if x == "en" else 20)), x, None, None) for k, x in enumerate(["en", "xx"] * 30)
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long")
    assert all(r.lang_pred == texts[r.doc_id][2] for r in language.identify(docs).collect())
