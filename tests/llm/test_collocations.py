"""Phrases against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest

from poolweave.llm import collocations, queries
from poolweave.llm.fm_index import Index

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows, least, top):
    """The contract's rows from (lang, text), one count after the other."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = tuple(w for w in re.split(r"[ \t]+", piece) if w)
            n[lang] += len(words)
            for k in range(1, 6):
                f.update((lang, words[i : i + k]) for i in range(len(words) - k + 1))
    frequent = {p: a for p, a in f.items() if len(p[1]) >= 2 and a >= least}
    covered = set()
    for (lang, words), a in frequent.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                if 100 * a >= 100 * frequent[lang, words[i : i + k]]:
                    covered.add((lang, words[i : i + k]))
    out = {}
    for (lang, words), a in frequent.items():
        if (lang, words) in covered:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = f[lang, words[:k]], f[lang, words[k:]]
            cuts.append((1000 * a * n[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((" ".join(words), a, left, right, n[lang], score))
    rows = []
    for lang, own in out.items():
        own.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        rows += [(lang, k + 1, *r) for k, r in enumerate(own[:top])]
    return sorted(rows)


def invented(seed, n, lang=None):
    rng = random.Random(seed)
    words = ["the", "The", "éa", "of", "new", "york", "in", "x-y", "zu", "É", "a", " b"]
    marks = [" ", " ", "  ", "\t", ", ", ".", "\n", " ! ", "\x0b", "; "]
    return [
        (lang or rng.choice(["en", "fr", None]),
         "".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randrange(60))) + rng.choice(["new york city", ""]))
        for _ in range(n)
    ]


@pytest.mark.parametrize("shard", [300, 8 << 20])
def test_against_plain_counts(spark, monkeypatch, shard):
    monkeypatch.setattr(collocations, "SHARD_BYTES", shard)
    monkeypatch.setattr(collocations, "PART_WORDS", 10 * shard)
    rows = invented(1, 300) + [("en", None), (None, ""), ("en", " \t"), ("fr", "a" * 50_000), ("en", "in the new york zu " * 3000)]
    rows += rows[:10]
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    for least, top in ((3, 2000), (12, 15)):
        got = collocations.collocations(frame.selectExpr("*", "1 AS n", "'x' AS phrase"), least, top)
        assert sorted(tuple(r) for r in got.collect()) == counted(rows, least, top)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("phrase_shards")]


def test_empty_table(spark, nothing):
    assert collocations.collocations(nothing).collect() == []


def test_intervals_hold_their_phrases():
    rng = np.random.default_rng(4)
    text = rng.integers(0, 5, 400).astype(np.int32)
    text[-1] = 0
    index = Index.of(text)
    phrases = index.words()
    for k in range(2, 6):
        phrases = index.extended(phrases).phrases
        expected = Counter(tuple(w) for w in np.lib.stride_tricks.sliding_window_view(text, k) if w.all())
        assert sorted(phrases.size) == sorted(expected.values())


def test_query_matches_sql(spark):
    tables = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tables}/documents.parquet'")
    expected = con.sql(queries.ORACLES["op13_phrase_mining"]).fetchall()
    got = queries.op13_phrase_mining(spark, tables)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected) and len(expected) > 50


def test_files_of_a_run_are_smaller_than_the_texts(spark):
    rng = np.random.default_rng(5)
    words = np.array([f"{'abcdefg'[k % 7] * 3}{k:x}" for k in range(5000)])
    texts = [" ".join(words[np.minimum(rng.zipf(1.3, 3000), 5000) - 1]) for _ in range(100)]
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    used = lambda: sum(f.stat().st_size for f in folder.rglob("*.parquet"))
    before = used()
    docs = spark.createDataFrame([("en", t) for t in texts], "lang string, text string").coalesce(1)
    assert collocations.collocations(docs).count() > 0
    assert used() - before < sum(map(len, texts))


@pytest.mark.parametrize("n, limit", [(1, 1), (1, 1 << 40), (5, 3), (1000, 1), (3000, 1 << 34), (500, 1 << 62)])
def test_rising_numbers_take_few_bits(n, limit):
    from poolweave.llm.packed import pack_rising, unpack_rising

    values = np.sort(np.random.default_rng(n).integers(0, limit, n))
    data = pack_rising(values.astype(np.uint64))
    assert (unpack_rising(data, n) == values).all()
    assert 8 * len(data) <= n * (max(0, np.log2(limit / n)) + 2.1) + 32


@pytest.mark.parametrize("most, parts", [(0, 1), (2, 7), (40_000, 33), ((1 << 32) - 1, 9000)])
def test_keys_tell_their_ids(most, parts):
    from poolweave.llm.collocations import Keys

    first, last = np.random.default_rng(6).integers(0, most, (2, 4000), endpoint=True)
    keys = Keys(most, parts)
    numbers, order = keys.ordered(first, last)
    assert (np.diff(numbers.astype(object)) >= 0).all()
    assert [x.tolist() for x in keys.ids(numbers)] == [first[order].tolist(), last[order].tolist()]
    assert keys.part_of(numbers).max() < parts
    assert (numbers >= keys.begin_of(1) * keys.part_of(numbers).astype(np.uint64)).all()
