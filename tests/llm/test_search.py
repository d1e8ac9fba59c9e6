"""Top-k search, URL rules and benchmark search against plain loops."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from poolweave.llm import decontaminate, topk, urls

from .conftest import sentence


def brute_top(rows, k, every):
    vectors = {}
    for key, vec in rows:
        if key is None or vec is None or any(v is None or not math.isfinite(v) for v in vec):
            continue
        whole = [math.floor(256 * v) for v in vec]
        vectors[key] = min(vectors.get(key, whole), whole)
    out = set()
    for q, a in vectors.items():
        if q % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), key) for key, b in vectors.items() if key != q)
            out |= {(q, r + 1, key, -s) for r, (s, key) in enumerate(scores[:k])}
    return out


@pytest.mark.parametrize(("k", "every"), [(5, 10), (3, 1), (200, 50)])
def test_top_k(spark, monkeypatch, k, every):
    monkeypatch.setattr(topk, "BLOCK", 16)
    rng = np.random.default_rng(k)
    rows = [(int(i), [float(v) for v in rng.normal(size=4)]) for i in range(100)]
    rows += [(i, [0.5, 0.5, 0.0, 0.0]) for i in range(100, 140)]  # ties, a hot vector
    rows += [(200, None), (250, [1.0, None]), (300, [math.nan, 1.0]), (350, [math.inf]), (None, [1.0]), (400, [])]
    rows += [(450, [1.0, 2.0]), (10, rows[10][1]), (500, [3e30, -2.0]), (550, [1.0] * 9)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    usable = [r for r in rows if r[0] != 500]
    small = topk.top_k(frame.filter("vec_id <> 500 OR vec_id IS NULL"), k, every).collect()
    assert {tuple(r) for r in small} == brute_top(usable, k, every)
    wide = topk.top_k(frame, k, every).filter("query_id <> 500 AND vec_id <> 500").count()
    assert wide <= len(small)


def test_vectors_stay_where_they_are(spark, monkeypatch):
    """What is shuffled does not grow with the blocks of queries, and no plan joins blocks."""
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(v) for v in rng.normal(size=8)]) for i in range(640)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    seen = []

    def counted(candidates, group, k, reach, top=topk._top_of_group):
        result = top(candidates, group, k, reach)
        plan = result._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "matrix" not in plan.split("MapInArrow")[0]
        seen.append(group.count())
        return result

    monkeypatch.setattr(topk, "_top_of_group", counted)
    monkeypatch.setattr(topk, "BLOCK", 16)
    results = []
    for size in (1, 8):
        monkeypatch.setattr(topk, "GROUP", size)
        results.append({tuple(r) for r in topk.top_k(frame, 5, 8).collect()})
    assert results[0] == results[1] == brute_top(rows, 5, 8)
    assert max(seen[:-1]) <= 8 and sum(seen) >= 10


def test_top_k_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(empty).count() == 0
    alone = spark.createDataFrame([(50, [1.0])], "vec_id long, embedding array<float>")
    assert topk.top_k(alone).count() == 0


def test_scores_beyond_doubles_are_exact():
    a = np.array([[2.0**40, 3.0]])
    assert topk.scores(a, np.array([[2.0**20, 1.0]]))[0, 0] == 2**60 + 3
    assert topk.scores(a, np.array([[2.0**40, 1.0]]))[0, 0] == 2**63 - 1


URLS = [
    "https://WWW.Example.NET/en/x?y#z", "http://example.net", "http://net/", "http://a.net?x=/y", "https://notexample.com/de/",
    "https://example.com/de/1", "https://x.example.com/dex", "http://é.org/fr/ü", "http://org/fr", "://", "no scheme", "", None,
    "ftp://user@host.org:80/fr/a://b", "https://exämple.net/en/", "http://a.org/fr/" + "x" * 3000, "x://y\n/z",
]


def brute_url(url):
    place = (url or "").find("://")
    if place < 0:
        return "", "", None
    rest = url[place + 3 :]
    host = re.split("[/?#]", rest)[0]
    path = re.split("[?#]", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fit, key=lambda r: len(r.text)) if fit else None


def test_urls(spark):
    pages = spark.createDataFrame([(k, u) for k, u in enumerate(URLS)] + [(0, URLS[0]), (None, URLS[1])], "page_id long, url string")
    pages = pages.withColumns({"host": F.lit("clash"), "grams": F.lit(1)})
    rows = urls.judge(pages, urls.labelled_urls(spark)).collect()
    assert len(rows) == len(URLS) + 2
    for r in rows:
        url = URLS[r.page_id] if r.page_id is not None else URLS[1]
        host, path, rule = brute_url(url)
        assert (r.host, r.path, r.rule) == (host, path, rule and rule.text)
        assert r.verdict == (rule.verdict if rule else "block" if r.blocking >= 0.5 else "allow")
        if not host:
            assert r.verdict == "allow"
    assert urls.judge(pages.limit(0), urls.labelled_urls(spark)).count() == 0


HELD_OUT = (
    "viagra-discount malware-download phishing-login slots-poker xxx-video payday-loans fake-watches torrent-crack "
    "casino-win free-bets ads-track spam-farm cheap-pills adult-x"
).split()
HARMLESS = "ththan tionsh therer ononth city-news river-school quiet-garden baker-street sunday-reader old-maps".split()


def test_url_model(spark):
    """It parts the labelled table, and hosts whose names are not in it: nine of ten."""
    known = [(u, 0) for u in urls.ALLOWED_URLS] + [(u, 1) for u in urls.BLOCKED_URLS]
    assert not any(h in u for u, _ in known for h in HELD_OUT + HARMLESS)
    new = [(f"https://q{k}.{h}.example.com/xx/{k}", int(h in HELD_OUT)) for k, h in enumerate(HELD_OUT + HARMLESS)]
    every = known + new
    pages = spark.createDataFrame([(k, u) for k, (u, _) in enumerate(every)], "page_id long, url string")
    rows = urls.judge(pages, urls.labelled_urls(spark), rules=()).collect()
    right = [(r.verdict == "block") == bool(every[r.page_id][1]) for r in sorted(rows, key=lambda r: r.page_id)]
    assert sum(right[: len(known)]) >= 0.97 * len(known)
    found = right[len(known) :]
    assert sum(found[: len(HELD_OUT)]) >= 0.9 * len(HELD_OUT) and all(found[len(HELD_OUT) :])
    none = spark.createDataFrame([(None, 1), ("https://a.b", None)], "url string, blocked int")
    assert set(urls.train(none)) == {0.0}
    with pytest.raises(ValueError):
        urls.train(spark.range(urls.MAX_LABELLED + 1).select(F.col("id").cast("string").alias("url"), F.lit(1).alias("blocked")))


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for k, y in enumerate(b):
            row[k + 1], last = (last + 1 if x == y else max(row[k + 1], row[k])), row[k + 1]
    return row[-1]


def test_longest_common_subsequence():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = (rng.integers(0, 6, rng.integers(1, 70)).astype(np.uint64) for _ in range(2))
        assert decontaminate.common_words(a, b) == lcs(a.tolist(), b.tolist())


def test_benchmark_passages(spark, make_docs):
    chosen = random.Random(2)
    items = {k: sentence(900 + k, chosen.randrange(15, 60), 4000) for k in range(40)}
    items |= {97: "too short", 98: None, 99: sentence(77, 150, 4000)}
    texts, expected = {}, set()
    for k in range(120):
        body = sentence(5000 + k, chosen.randrange(0, 300), 4000).split()
        if k % 3 == 0:
            item = chosen.choice(list(range(40)))
            passage = items[item].split()
            if k % 2:  # a paraphrase: some words changed, one left out
                for _ in range(len(passage) // 10):
                    passage[chosen.randrange(len(passage))] = "changed"
                passage.pop(chosen.randrange(len(passage)))
            at = chosen.randrange(len(body) + 1)
            body[at:at] = [p.upper() if k % 5 == 0 else p for p in passage]
            expected.add((k, item))
        texts[k] = " ".join(body)
    texts[500] = items[99]
    expected.add((500, 99))
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string").withColumn("doc_id", F.lit(1))
    found = decontaminate.contaminated(make_docs(texts), bench).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert got <= expected
    assert len(got & expected) >= 0.95 * len(expected)


def test_benchmark_in_several_passes(spark, make_docs, monkeypatch):
    items = {k: sentence(900 + k, 20, 4000) for k in range(12)}
    texts = {k: sentence(1, 50, 4000) + " " + items[k] for k in range(12)}
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    monkeypatch.setattr(decontaminate, "MAX_PASSAGES", 5)
    found = decontaminate.contaminated(make_docs(texts), bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(k, k) for k in range(12)}


def test_benchmark_with_awkward_rows(spark, awkward, awkward_rows, nothing):
    bench = spark.createDataFrame([(1, awkward_rows[0][1]), (2, None), (None, "x")], "item_id long, text string")
    found = decontaminate.contaminated(awkward, bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 1), (2, 1), (10, 1)}
    assert decontaminate.contaminated(nothing, bench).count() == 0
    assert decontaminate.contaminated(awkward, bench.limit(0)).count() == 0


def test_copies_of_many_items(spark, make_docs):
    """With 1,500 items each verbatim copy is found, as with few."""
    items = {k: sentence(20_000 + k, 15 + k % 45, 4000) for k in range(1500)}
    texts = {k: f"{sentence(50_000 + k, 40, 4000)} {items[k]} {sentence(60_000 + k, 40, 4000)}" for k in range(0, 1500, 5)}
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    found = decontaminate.contaminated(make_docs(texts), bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(k, k) for k in texts}


def test_short_items_are_whole_sequences(spark, make_docs):
    """Every verbatim copy of an item of 1 to 15 words, and nothing that is not there."""
    rng = random.Random(8)
    items = {k: " ".join(f"q{k}x{rng.randrange(9)}" for _ in range(1 + k % 15)) for k in range(60)}
    items |= {90: items[20], 91: "Twice  SAID", 92: None, 93: " ", 94: "never in any text"}
    texts = {}
    for k, item in items.items():
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(80))]
        at = rng.randrange(len(words) + 1)
        texts[k] = " ".join(words[:at] + ([item.upper()] if item and k < 92 else []) + words[at:])
    texts |= {200: "twice said twice\tsaid", 201: "twicesaid twice", 202: "never in any", 203: "text", 204: None}
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    rows = decontaminate.contaminated(make_docs(texts), bench).collect()
    found = {(r.doc_id, r.item_id) for r in rows}
    expected = {
        (d, k)
        for d, t in texts.items() for k, item in items.items()
        if item and item.split() and f" {' '.join(item.lower().split())} " in f" {' '.join((t or '').lower().split())} "
    }
    assert found >= expected and {(k, k) for k in range(60)} <= found
    assert all(pair in expected for pair in found if len(items[pair[1]].split()) < decontaminate.LEAST_WORDS)
    assert all(r.exact for r in rows if (r.doc_id, r.item_id) in expected)
    [twice] = [r for r in rows if r.doc_id == 200]
    assert (twice.item_id, twice.first_word, twice.common) == (91, 0, 1.0)
