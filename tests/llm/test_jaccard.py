"""The Jaccard join against all pairs, and its parts against brute force."""

import random
import re

import numpy as np
import pytest

from poolweave.llm import jaccard
from poolweave.llm.components import components

from .conftest import sentence


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()


def brute(texts, spec):
    sets = {k: shingles(t, spec.words) for k, t in texts.items()}
    group = {k: k for k in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if spec.den * common >= spec.num * (len(sets[a]) + len(sets[b]) - common):
                    x, y = sorted((group[a], group[b]))
                    group = {k: x if v == y else v for k, v in group.items()}
    return {k: (len(sets[k]), group[k]) for k in sets}


def near_copies(seed, families=6, members=12):
    chosen = random.Random(seed)
    texts = {}
    for family in range(families):
        base = sentence(seed * 100 + family, chosen.randrange(5, 140)).split()
        for _ in range(members):
            words = list(base)
            for _ in range(chosen.randrange(0, 5)):
                words[chosen.randrange(len(words))] = f"n{chosen.randrange(10**6)}"
            if chosen.random() < 0.2:
                words = words[: chosen.randrange(len(words)) + 1]
            texts[len(texts)] = " ".join(words).upper() if chosen.random() < 0.2 else " ".join(words)
    return texts


@pytest.mark.parametrize("spec", [jaccard.Spec(), jaccard.Spec(5, 80, 100)])
@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_near_copies(make_docs, spec, seed):
    texts = near_copies(seed)
    rows = jaccard.similar_sets(make_docs(texts), spec).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(texts, spec)


def test_long_lists_are_dealt_out(make_docs, monkeypatch):
    """Index lists beyond the limit come back as entries and are paired part by part."""
    spec = jaccard.Spec()
    rng = np.random.default_rng(3)
    n = 60
    size, pos = rng.integers(20, 24, n), rng.integers(0, 3, n)
    order = np.lexsort((pos, size))
    a, b = jaccard.list_pairs(size[order], pos[order], np.zeros(n, int), spec)
    got = {tuple(sorted((int(order[x]), int(order[y])))) for x, y in zip(a, b)}
    expected = set()
    for x in range(n):
        for y in range(x):
            small, large = sorted((size[x], size[y]))
            common = spec.least_common(small, large)
            if small >= spec.least_size(large) and size[x] - pos[x] >= common and size[y] - pos[y] >= common:
                expected.add((y, x))
    assert expected <= got
    assert len(a) == len(set(zip(a, b)))


def test_parts_of_a_long_list_meet_once(spark):
    fields = f"length long, {jaccard._ENTRY}"
    long = spark.createDataFrame([(10_000, 1, 10, 0, d, 0, 0, 0, 0, 0, d) for d in range(200)], fields)
    dealt = jaccard._dealt(long).collect()
    meetings = {}
    for r in dealt:
        meetings.setdefault((r.part, r.other), []).append((r.doc, r.mine))
    pairs = []
    for (part, other), docs in meetings.items():
        pairs += [
            (x, y) for x, i in docs for y, j in docs if x < y and (part == other or i != j)
        ]
    assert len(pairs) == len(set(pairs)) == 200 * 199 // 2


def test_components_through_long_lists(make_docs, monkeypatch):
    """The same components when every list counts as long and is paired part by part."""
    monkeypatch.setattr(jaccard, "LONG_LIST", 3)
    source = jaccard._candidates

    def paired(entries, spec, first_round, name):
        long = entries.withColumn("length", jaccard.F.lit(10))
        return source(jaccard._dealt(long), spec, first_round, split=False)

    monkeypatch.setattr(jaccard, "_paired", paired)
    texts = near_copies(7)
    rows = jaccard.similar_sets(make_docs(texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(texts, jaccard.Spec())


def test_awkward_rows(awkward, awkward_rows, nothing):
    rows = {r.doc_id: r for r in jaccard.similar_sets(awkward).collect()}
    texts = {r[0]: r[1] for r in awkward_rows if r[0] is not None}
    assert set(rows) == set(texts)  # one row for each id
    assert {k: (r.n_shingles, r.component_id) for k, r in rows.items()} == brute(texts, jaccard.Spec())
    assert jaccard.similar_sets(nothing).count() == 0


def test_connected_components(spark):
    chosen = random.Random(5)
    links = [(k, k + 1) for k in range(100, 140)] + [(200, k) for k in range(201, 230)]
    links += [(chosen.randrange(1000, 1400), chosen.randrange(1000, 1400)) for _ in range(250)]
    group = {}
    for a, b in links:
        if a != b:
            x, y = sorted((group.setdefault(a, a), group.setdefault(b, b)))
            group = {k: x if v == y else v for k, v in group.items()}
    least = {}
    for k, v in group.items():
        least[v] = min(least.get(v, k), k)
    rows = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in rows} == {k: least[v] for k, v in group.items()}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
