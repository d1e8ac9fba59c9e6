"""Sorting, stored order and violations."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from poolweave.operators import ordering
from poolweave.operators.ordering import available_keys, sort_panel, with_position
from poolweave.operators.quality import sort_violations
from poolweave.plans import checks
from poolweave.plans.checks import check_order, check_readable, check_sorted_output
from poolweave.sinks.tables import export_sorted_csv, write_countries, write_sorted
from poolweave.sources import tables

HEADER = "country RREL3 RREC3 RREL6 note"


def panel_rows(n: int, seed: int = 3) -> list[tuple]:
    rng = random.Random(seed)
    loans = [None, "9", "10", "a", "A", "é"] + [str(i) for i in range(40)]
    return [
        (
            rng.choice(["DE", "IT", "IT", "IT", None]),
            rng.choice(loans),
            rng.choice([None, "1", "2"]),
            rng.choice([None, "2020-01", "2020-02"]),
            str(rng.randrange(3)),
        )
        for _ in range(n)
    ]


def nulls_last(value):
    return (value is None, (value or "").encode())


def in_order(data):
    return sorted(data, key=lambda r: [nulls_last(v) for v in r])


def test_keys_that_exist():
    with pytest.warns(UserWarning, match="RREC3"):
        assert available_keys(["RREL6", "RREL3"]) == ["RREL3", "RREL6"]
    with pytest.raises(ValueError, match="No sort columns"), pytest.warns(UserWarning):
        available_keys(["x"])


def test_sort_panel_is_a_total_order(strings):
    data = panel_rows(500)
    df = strings(HEADER, *data)
    ordered = sort_panel(df, group=["country"], break_ties=True, partitions=7)
    got = [tuple(r) for r in ordered.collect()]
    known = [r for r in got if r[0] is not None]
    assert known == in_order([r for r in data if r[0] is not None])
    assert sorted(got, key=repr) == sorted(data, key=repr)
    assert ordered.rdd.getNumPartitions() > 1


def test_ranges_become_more_with_the_rows(strings, monkeypatch):
    monkeypatch.setattr(ordering, "RANGE_VALUES", 50)
    data = panel_rows(100)
    ordered = sort_panel(strings(HEADER, *data), group=["country"])
    assert ordered.rdd.getNumPartitions() == 100 * 5 // 50 + 1
    assert rows(ordered) == sorted(data, key=repr)


def test_one_hot_key_spreads(spark):
    df = spark.range(4000).select(
        F.lit("IT").alias("country"), F.lit("L").alias("RREL3"), F.lit("1").alias("RREC3"),
        F.lit("2020-01").alias("RREL6"),
    )
    ordered = sort_panel(df.repartition(8), group=["country"], partitions=8)
    sizes = ordered.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 4
    assert sum(r["count"] for r in sizes) == 4000


@pytest.mark.parametrize("partitions", [1, 5])
def test_positions(strings, partitions):
    data = [r for r in panel_rows(400) if r[0] is not None]
    numbered = with_position(
        strings(HEADER, *data), group=["country"], partitions=partitions
    )
    for country in ("DE", "IT"):
        mine = [tuple(r) for r in numbered.filter(F.col("country") == country).collect()]
        mine.sort(key=lambda r: r[-1])
        assert [r[-1] for r in mine] == list(range(1, len(mine) + 1))
        assert [r[:-1] for r in mine] == in_order([r for r in data if r[0] == country])
    everyone = with_position(strings(HEADER, *data), partitions=partitions)
    assert sorted(r.position for r in everyone.collect()) == list(range(1, len(data) + 1))


def brute_violations(data):
    found = 0
    for a, b in zip(data, data[1:]):
        if a[0] is None:
            continue
        comparisons = []
        for x, y in zip(b, a):
            known = x is not None and y is not None
            comparisons.append((known and x < y, known and x == y))
        (l3, e3), (lc, ec), (l6, _) = comparisons
        found += l3 or (e3 and lc) or (e3 and ec and l6)
    return found


@pytest.mark.parametrize("chunk_rows", [1, 3, 10, 1000])
def test_violations_across_chunks(spark, chunk_rows):
    data = [r[1:4] for r in panel_rows(200, seed=8)]
    stored = spark.createDataFrame(
        [("IT", i // chunk_rows, i, *r) for i, r in enumerate(data)]
        + [("DE", 0, i, str(i), "1", "x") for i in range(9)],
        "country string, chunk long, place long, RREL3 string, RREC3 string, RREL6 string",
    )
    found = sort_violations(stored, ["country"], ["chunk"], ["place"])
    assert rows(found) == [("DE", 9, 0), ("IT", 200, brute_violations(data))]


def test_stored_chunks_are_dealt_by_their_number(spark, strings, monkeypatch, tmp_path):
    data = [("DE", f"{k:04}", "1", "2020-01", "x") for k in range(90)]
    path = str(tmp_path / "sorted")
    write_sorted(sort_panel(strings(HEADER, *data), group=["country"], partitions=2), path)
    for module in (tables, checks):
        monkeypatch.setattr(module, "STORED_CHUNK_ROWS", 10)
    order = check_order(spark, path)
    assert f", {90 // (checks.CHUNKS_PER_TASK * 10) + 1}), REPARTITION_BY_NUM" in order._jdf.queryExecution().executedPlan().toString()
    assert rows(order) == [("DE", 90, 0, "PASS")]


def test_written_order(spark, strings, tmp_path):
    data = [r for r in panel_rows(600) if r[0] is not None]
    df = strings(HEADER, *data)
    source, target = str(tmp_path / "countries"), str(tmp_path / "sorted")
    write_countries(df, source)
    write_sorted(sort_panel(spark.read.parquet(source), group=["country"], partitions=5), target)

    counts = {c: sum(r[0] == c for r in data) for c in ("DE", "IT")}
    order = check_order(spark, target)
    assert rows(order) == [(c, n, 0, "PASS") for c, n in sorted(counts.items())]
    assert rows(check_order(spark, source), "status") == [("FAIL",), ("FAIL",)]

    report = check_sorted_output(spark, source, target)
    assert rows(report, "country", "status", "rows_before", "rows_after") == [
        (c, "PASS", n, n) for c, n in sorted(counts.items())
    ]
    assert rows(check_sorted_output(spark, source, target, ["DE"]), "country") == [("DE",)]
    readable = check_readable(spark, target)
    assert rows(readable, "country", "rows", "columns") == [
        (c, n, 4) for c, n in sorted(counts.items())
    ]


def test_csv_export_in_order(spark, strings, tmp_path):
    data = [r for r in panel_rows(300) if r[0] is not None]
    target = tmp_path / "csv"
    ordered = sort_panel(strings(HEADER, *data), group=["country"], partitions=4, break_ties=True)
    export_sorted_csv(ordered, str(target))
    for country in ("DE", "IT"):
        lines = []
        for part in sorted((target / f"country={country}").glob("part-*.csv")):
            header, *body = part.read_text().splitlines()
            assert header == "RREL3,RREC3,RREL6,note"
            lines += body
        expected = in_order([r for r in data if r[0] == country])
        assert lines == [",".join(v or "" for v in r[1:]) for r in expected]
