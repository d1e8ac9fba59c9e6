"""Vector links against all pairs."""

from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest

from poolweave.llm import near_vectors, queries

SCHEMA = "vec_id long, embedding array<float>, label int, cls string, n int, component string"


def all_pairs(rows, cosine=0.95):
    """(n_links, component_id, kept) of every row by comparing all of them."""
    good = [
        k for k, (i, v) in enumerate(rows)
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    links = {k: set() for k in good}
    lengths = {}
    for k in good:
        lengths.setdefault(len(rows[k][1]), []).append(k)
    for places in lengths.values():
        m = np.array([np.float32(rows[k][1]) for k in places], np.float64)
        norm = np.linalg.norm(m, axis=1)
        hit = (m @ m.T) / np.outer(norm, norm) >= cosine
        for i, k in enumerate(places):
            links[k] = {places[j] for j in np.flatnonzero(hit[i]) if places[j] != k}
    out = [(0, i, True) for i, _ in rows]
    seen = set()
    for k in good:
        if k in seen:
            continue
        reached, todo = {k}, [k]
        while todo:
            new = links[todo.pop()] - reached
            reached |= new
            todo += new
        seen |= reached
        least = min(rows[j][0] for j in reached)
        for j in reached:
            out[j] = (len(links[j]), least, rows[j][0] == least)
    return sorted(((rows[k][0], *out[k]) for k in range(len(rows))), key=str)


def got(spark, rows):
    frame = spark.createDataFrame([(i, v, 1, "x", 2, "y") for i, v in rows], SCHEMA).repartition(5)
    return sorted((tuple(r) for r in near_vectors.near_vectors(frame).collect()), key=str)


def group(rng, size, noise, dims=64):
    base = rng.standard_normal(dims)
    base /= np.linalg.norm(base)
    return base + rng.standard_normal((size, dims)) * noise / math.sqrt(dims)


@pytest.mark.parametrize("noise", [0.08, 0.14, 0.2])
def test_groups_and_lone_vectors(spark, noise):
    """A group of a third of all rows, tight or loose, many small ones, and lone vectors."""
    rng = np.random.default_rng(int(noise * 100))
    parts = [group(rng, 600, noise), rng.standard_normal((900, 64))]
    parts += [group(rng, int(rng.integers(2, 9)), noise) for _ in range(60)]
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(np.concatenate(parts))]
    rng.shuffle(rows)
    found, true = got(spark, [(int(i), v) for i, v in rows]), all_pairs([(int(i), v) for i, v in rows])
    links = [sum(r[1] for r in x) for x in (found, true)]
    assert links[0] <= links[1] and links[0] >= 0.99 * links[1]
    assert all(a[1] <= b[1] for a, b in zip(found, true))
    if noise < 0.1:
        assert found == true


def test_pairs_at_the_threshold(spark):
    """Pairs of cosine 0.95 to 0.96 are the hardest: at least 0.98 of them are found."""
    rng = np.random.default_rng(9)
    rows = []
    for k in range(400):
        a, b = rng.standard_normal((2, 48))
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        c = rng.uniform(0.9501, 0.96)
        rows += [(2 * k, [float(x) for x in a]), (2 * k + 1, [float(x) for x in c * a + math.sqrt(1 - c * c) * b])]
    assert sum(r[1] for r in got(spark, rows)) >= 0.98 * sum(r[1] for r in all_pairs(rows))


def test_awkward_vectors(spark):
    rng = np.random.default_rng(2)
    v = [float(x) for x in rng.standard_normal(8)]
    rows = [
        (1, v), (2, v), (2, v), (3, [2 * x for x in v]), (4, None), (5, []), (6, [0.0] * 8), (7, [None, *v[1:]]),
        (8, [math.nan, *v[1:]]), (9, [math.inf, *v[1:]]), (None, v), (10, v[:4]), (11, v[:4]), (12, [-x for x in v]),
        (13, [1e-38] * 8), (14, [3e38] * 8), (15, [-0.0, 1.0]), (16, [0.0, 1.0]),
    ]
    assert got(spark, rows) == all_pairs(rows)
    assert got(spark, []) == []
    # One vector in all rows.
    assert got(spark, [(k, v) for k in range(50)]) == [(k, 49, 0, k == 0) for k in sorted(range(50), key=lambda k: str((k, 49, 0, k == 0)))]


def test_number_of_tables_follows_the_rows():
    small, large = near_vectors.tables_for(500), near_vectors.tables_for(5_000_000)
    assert small.projections < large.projections and small.tables < large.tables < 200


def test_query_matches_sql(spark):
    tables = "/root/testdata/sf0.01"
    result = queries.op11_embedding_near_dedup(spark, tables)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{tables}/embeddings.parquet'")
    assert sorted(tuple(r) for r in result.collect()) == sorted(con.sql(queries.ORACLES["op11_embedding_near_dedup"]).fetchall())
