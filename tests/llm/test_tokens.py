"""Counts and packed ids against the tokenizer library."""

import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import pytest

from poolweave.llm import packing, token_counts, tokens
from poolweave.session import scratch_path

ODD = [
    "", "  ", "—!! …? x", "a…! «été». №5", "İstanbul ΣΑΣ ὈΔΥΣΣΕΎΣ é ﬁ", "don't <|endoftext|> x<|endoftext|>y",
    "a_b __ 12ab ß ÀÉ. Été... ñ!!! x'", "中文 字 テスト,  a b\u0085c", "l'été d'Ér \x1c \x1d a̸ ≮ ab≮", "Kſ K's 're ÅÅ",
    "word!!!!word <|startoftext|>", "\x00\x01 nul",
]


def library(texts):
    encoded = tokens.load(tokens.TOKENIZER).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [e.ids for e in encoded]


def test_ids_agree_with_the_library(awkward_rows):
    texts = ODD + [r[1] or "" for r in awkward_rows]
    ids, first = tokens.WordIds().encode(pa.array(texts))
    assert [list(ids[a:b]) for a, b in zip(first, first[1:])] == library(texts)


def test_every_letter_before_punctuation():
    """Letters that take marks when lower-cased or composed join the punctuation behind."""
    letters = [chr(c) for c in range(128, 0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isalpha()]
    shaped = [x for x in letters if not unicodedata.normalize("NFC", x).lower().isalpha()]
    assert {"İ", "\u0958", "\u09dc"} <= set(shaped)
    texts = [f"a{x}!" for x in letters] + [f"{x}{m} b{x}" for x in shaped for m in "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"]
    texts += ["GELİRİ, x", "TARİHİ.", "İ!", "şİ... y"]
    words = tokens.WordIds()
    for first in range(0, len(texts), 20_000):
        part = texts[first : first + 20_000]
        ids, at = words.encode(pa.array(part))
        wrong = [t for t, a, b, e in zip(part, at, at[1:], library(part)) if list(ids[a:b]) != e]
        assert not wrong


def test_white_space_of_any_kind_is_one_space(spark, make_docs):
    cache = scratch_path(spark, "cache")
    token_counts.count_tokens(make_docs(["a b", "a \nb", "a\n \nb", "a \n b", "a\t\x0b\x0c\r b"]), cache)
    assert spark.read.parquet(cache).count() == 1


def test_entries_written_twice_count_once(spark, make_docs):
    cache = scratch_path(spark, "cache")
    docs = make_docs(["one two", "three", "one two"])
    token_counts.count_tokens(docs, cache)
    spark.read.parquet(cache).write.mode("append").parquet(cache + "-twice")
    spark.read.parquet(cache).write.mode("append").parquet(cache + "-twice")
    assert token_counts.count_tokens(docs, cache + "-twice").count() == 3


def test_a_full_store_starts_anew():
    words = tokens.WordIds(limit=50)
    for k in range(20):
        text = f"alpha{k} beta. {k} gamma{k}!! don't"
        assert words.count(pa.array([text]))[0] == len(library([text])[0])
    assert words.n <= 60


def test_counts(spark, awkward, awkward_rows, nothing):
    cache = scratch_path(spark, "cache")
    rows = token_counts.count_tokens(awkward, cache).collect()
    assert len(rows) == len(awkward_rows)
    expected = {r[0]: (len((r[1] or "").encode()), len(library([r[1]])[0])) for r in awkward_rows}
    assert all((r.n_bytes, r.n_tokens) == expected[r.doc_id] for r in rows)
    assert token_counts.count_tokens(nothing, cache).count() == 0
    # Contents that differ in white space only are one entry.
    assert spark.read.parquet(cache).count() == len({" ".join((r[1] or "").split(" ")) for r in awkward_rows})


def test_only_misses_are_encoded(spark, make_docs):
    cache = scratch_path(spark, "cache")
    token_counts.count_tokens(make_docs(["one two", "one  two", None]), cache)
    assert spark.read.parquet(cache).count() == 2
    known = spark.read.parquet(cache)
    forged = scratch_path(spark, "cache")
    known.withColumn("n_tokens", known.n_tokens + 100).write.parquet(forged)
    got = token_counts.count_tokens(make_docs(["one two", "three"]), forged).orderBy("doc_id").collect()
    assert [r.n_tokens for r in got] == [len(library(["one two"])[0]) + 100, len(library(["three"])[0])]


def check_packing(rows, texts):
    ids = {k: [*own, packing.END_ID] for k, own in zip(texts, library(texts.values()))}
    for key in ids:
        pieces = sorted((r for r in rows if r.doc_id == key), key=lambda r: r.start)
        at = 0
        for r in pieces:
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids[key])
            own = np.array(ids[key][at : at + r.length], "<u4")
            assert r.ids_crc32 == zlib.crc32(own.tobytes())
            at += r.length
        assert at == len(ids[key])
    sequences = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == sequences.get(r.sequence_id, 0)
        sequences[r.sequence_id] = r.offset + r.length
    assert all(n <= packing.WINDOW for n in sequences.values())
    return sequences


def test_packing(spark, awkward, awkward_rows, nothing):
    unique = {r[0]: r[1] for r in awkward_rows}
    docs = awkward.dropDuplicates(["doc_id"])
    sequences = check_packing(packing.pack(docs).collect(), unique)
    assert sum(n < packing.WINDOW for n in sequences.values()) <= 4  # one for each shard task
    assert packing.pack(awkward).agg({"length": "sum"}).first()[0] == sum(len(x) + 1 for x in library([r[1] for r in awkward_rows]))
    assert packing.pack(nothing).count() == 0


@pytest.mark.parametrize("words", [2046, 2047, 2048, 4095, 4096])
def test_borders_of_a_window(make_docs, words):
    texts = {0: "a " * words, 1: None}
    check_packing(packing.pack(make_docs(texts)).collect(), texts)


def test_neighbours_come_by_bm25():
    """A seed's neighbours and their order, against scores computed term by term."""
    rng = np.random.default_rng(1)
    docs = [rng.choice(40, rng.integers(3, 12), replace=False) for _ in range(30)]
    times = [rng.integers(1, 4, len(d)) for d in docs]
    terms = pa.array([np.sort(d).astype("<u2").tobytes() + t[np.argsort(d)].astype("u1").tobytes() for d, t in zip(docs, times)])
    frequency = np.bincount(np.concatenate(docs), minlength=1 << 16)
    idf = np.log1p((30 - frequency + 0.5) / (frequency + 0.5))
    mean = float(np.mean([len(d) for d in docs]))
    index = packing.Index(terms, idf, mean)
    unused = np.ones(30, bool)
    unused[:10:2] = False
    for seed in range(30):
        scores = {}
        for other in np.flatnonzero(unused):
            total = 0.0
            for term, n in zip(docs[other], times[other]):
                if term in docs[seed]:
                    scale = packing.K1 * (1 - packing.B + packing.B * times[other].sum() / mean)
                    total += idf[term] * n * (packing.K1 + 1) / (n + scale)
            if total:
                scores[other] = total
        got = index.neighbours(seed, unused)
        assert set(got) == set(scores)
        assert np.allclose([scores[k] for k in got], sorted(scores.values(), reverse=True))
