"""Skew handling never changes a result."""

import itertools

import pytest
from pyspark.sql import functions as F

from conftest import rows
from poolweave.operators.collateral import join_collateral, join_statistics, pair_files
from poolweave.operators.skew import balanced_left_join, hot_keys, lookup_join


def brute_left(left, right, null_safe):
    result = []
    for a in left:
        partners = [b for b in right if a[0] == b[0] and (null_safe or a[0] is not None)]
        result += [(*a, *b, True) for b in partners] or [(*a, None, None, None)]
    return sorted(result, key=repr)


LEFT = [("hot", str(i)) for i in range(20)] + [(None, str(i)) for i in range(6)]
LEFT += [("both", str(i)) for i in range(12)] + [("lone", "1"), ("one", "1"), ("rhot", "1")]
RIGHT = [("rhot", str(i)) for i in range(25)] + [(None, str(i)) for i in range(7)]
RIGHT += [("both", str(i)) for i in range(9)] + [("hot", "r"), ("one", "r"), ("unused", "r")]


@pytest.mark.parametrize("null_safe", [True, False])
@pytest.mark.parametrize("hot_rows", [5, 10, 1000])
def test_balanced_left_join(strings, hot_rows, null_safe):
    left, right = strings("k v", *LEFT), strings("rk w", *RIGHT)
    joined = balanced_left_join(
        left,
        right,
        [("k", "rk")],
        marker="found",
        null_safe=null_safe,
        hot_rows=hot_rows,
        fan_out=4,
    )
    assert joined.columns == ["k", "v", "rk", "w", "found"]
    assert rows(joined) == brute_left(LEFT, RIGHT, null_safe)


def test_equal_copies_are_kept(strings):
    left = strings("k v", *[("a", "same")] * 30)
    right = strings("rk w", *[("a", "copy")] * 20)
    joined = balanced_left_join(left, right, [("k", "rk")], marker="m", hot_rows=2, fan_out=3)
    assert joined.count() == 600


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize(("bound", "hot_rows"), [(100, 5), (0, 5), (0, 1000)])
def test_lookup_join(strings, how, bound, hot_rows):
    wide, lookup = strings("k v", *LEFT), strings("k c", ("hot", "H"), (None, "N"), ("one", "O"))
    joined = lookup_join(
        wide, lookup, ["k"], how, max_broadcast_rows=bound, hot_rows=hot_rows, fan_out=4
    )
    country = {"hot": "H", None: "N", "one": "O"}
    expected = {
        "left": [(k, v, country.get(k)) for k, v in LEFT],
        "inner": [(k, v, country[k]) for k, v in LEFT if k in country],
        "left_semi": [(k, v) for k, v in LEFT if k in country],
        "left_anti": [(k, v) for k, v in LEFT if k not in country],
    }[how]
    assert rows(joined) == sorted(expected, key=repr)


@pytest.mark.parametrize("max_listed", [0, 100])
def test_hot_keys_are_not_collected(strings, monkeypatch, max_listed):
    left, right = strings("k v", *LEFT), strings("rk w", *RIGHT)
    lookup = strings("k c", ("hot", "H"), (None, "N"), ("one", "O"))

    def collect(df):
        raise AssertionError("hot keys came to the driver")

    with monkeypatch.context() as patched:
        patched.setattr(type(left), "collect", collect)
        joined = balanced_left_join(
            left, right, [("k", "rk")], marker="found", hot_rows=5, fan_out=4, max_listed=max_listed
        )
        looked_up = lookup_join(
            left, lookup, ["k"], max_broadcast_rows=0, hot_rows=5, fan_out=4, max_listed=max_listed
        )
    assert rows(joined) == brute_left(LEFT, RIGHT, True)
    country = {"hot": "H", None: "N", "one": "O"}
    assert rows(looked_up) == sorted(((k, v, country.get(k)) for k, v in LEFT), key=repr)
    for df in (joined, looked_up):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert ("broadcast" in plan) == (max_listed > 0)


def test_hot_keys_are_counted(strings):
    assert rows(hot_keys(strings("k v", *LEFT), ["k"], 7)) == [("both", 12), ("hot", 20)]


def test_collateral_join(strings):
    loans = strings("RREL2 RREL3 Sec_Id NOTE", ("1", "a", "S", "l1"), ("2", "b", "S", "l2"))
    collateral = strings(
        "RREC2 Sec_Id RREC1 NOTE RREC3", ("1", "S", "c", "c1", "x"), ("1", "S", "c", "c2", "y")
    )
    joined = join_collateral(loans, collateral)
    assert joined.columns == [
        "RREL2", "RREL3", "Sec_Id", "NOTE", "RREC2", "NOTE_collateral", "RREC3",
    ]
    assert rows(joined) == [
        ("1", "a", "S", "l1", "1", "c1", "x"),
        ("1", "a", "S", "l1", "1", "c2", "y"),
        ("2", "b", "S", "l2", None, None, None),
    ]
    with pytest.raises(ValueError, match="No join key"):
        join_collateral(loans, strings("RRC2", ("1",)))


def test_missing_keys_meet_only_in_their_pair(strings):
    loans = strings("p RREL2", ("1", None), ("2", None), ("2", "k"))
    collateral = strings("p RREC2 RREC3", ("1", None, "x"), ("1", None, "y"), ("2", "k", "z"))
    joined = join_collateral(
        loans, collateral, ["p"], hot_rows=1, fan_out=2, match_null_keys=True
    )
    expected = [("1", None, None, "x"), ("1", None, None, "y"), ("2", None, None, None)]
    assert rows(joined) == sorted([*expected, ("2", "k", "k", "z")], key=repr)
    stats = join_statistics(loans, collateral, ["p"], ("RREL2", "RREC2"), match_null_keys=True)
    assert rows(stats) == [
        ("1", 1, 2, 2, 2, 0, "RREL2=RREC2"),
        ("2", 2, 1, 2, 1, 1, "RREL2=RREC2"),
    ]
    strict = join_statistics(loans, collateral, ["p"], ("RREL2", "RREC2"))
    assert rows(strict, "p", "merged_rows", "matched_rows") == [("1", 1, 0), ("2", 2, 1)]


def test_statistics_agree_with_the_join(strings):
    left = [(str(i % 3), str(i % 5) if i % 7 else None) for i in range(60)]
    right = [(str(i % 3), str(i % 4) if i % 5 else None, str(i)) for i in range(40)]
    loans, collateral = strings("p RREL2", *left), strings("p RREC2 RREC3", *right)
    stats = join_statistics(loans, collateral, ["p"], ("RREL2", "RREC2"), match_null_keys=True)
    for p, ue, coll, merged, matched, unmatched, _ in rows(stats):
        pairs = [
            (a, b) for a, b in itertools.product(left, right) if a == b[:2] and a[0] == p
        ]
        lone = [a for a in left if a[0] == p and a not in [b[:2] for b in right]]
        assert (ue, coll) == (sum(a[0] == p for a in left), sum(b[0] == p for b in right))
        assert (matched, unmatched, merged) == (len(pairs), len(lone), len(pairs) + len(lone))


def test_latest_collateral_file_wins(strings):
    header = "name asset_type category identifier date sequence"
    files = strings(
        header,
        ("u1", "RMB", "UE", "P", "d", "1"),
        ("u2", "RMB", "UE", "P", "d", "2"),
        ("c9", "RMB", "Collateral", "P", "d", "9"),
        ("c10", "RMB", "Collateral", "P", "d", "10"),
        ("c1", "NPE", "Collateral", "P", "d", "1"),
        ("u3", "RMB", "UE", "Q", "d", "1"),
    )
    assert rows(pair_files(files), "ue_name", "collateral_name") == [("u1", "c10"), ("u2", "c10")]


@pytest.fixture
def shuffled_joins(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, value in settings.items():
        spark.conf.set(k, value)
    yield
    for k, value in before.items():
        spark.conf.set(k, value)


@pytest.mark.parametrize("hot_side", ["left", "right"])
def test_a_hot_key_is_spread_over_tasks(spark, shuffled_joins, hot_side):
    third = [("hot", str(i)) for i in range(4000)]
    others = [(f"k{i}", str(i)) for i in range(8000)]
    many = spark.createDataFrame(third + others, "k string, v string").repartition(8, "v")
    few = spark.createDataFrame([("hot", "x"), ("k1", "y")], "k string, w string")
    left, right = (many, few) if hot_side == "left" else (few, many)
    right = right.withColumnRenamed("k", "rk")

    def task_sizes(hot_rows):
        joined = balanced_left_join(
            left, right, [("k", "rk")], marker="m", hot_rows=hot_rows, fan_out=64
        ).filter("k = 'hot'")
        counts = joined.groupBy(F.spark_partition_id()).count().collect()
        return sorted(r["count"] for r in counts)

    assert task_sizes(hot_rows=10_000) == [4000]
    spread = task_sizes(hot_rows=1000)
    assert sum(spread) == 4000 and len(spread) == 8 and spread[-1] < 1000


def test_a_hot_key_of_a_large_lookup_is_spread(spark, shuffled_joins):
    wide = spark.createDataFrame([("hot", str(i)) for i in range(4000)], "k string, v string")
    lookup = spark.createDataFrame([("hot", "x"), ("b", "y")], "k string, c string")
    joined = lookup_join(
        wide.repartition(8, "v"), lookup, ["k"], max_broadcast_rows=1, hot_rows=1000
    )
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 4000 and len(sizes) > 5 and max(sizes) < 1000
