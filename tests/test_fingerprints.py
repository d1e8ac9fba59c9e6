"""Checksums in order, reconciliation from sketches, distinct sketches."""

import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import rows
from poolweave.operators import country, pools, quality, reconcile, sketches
from poolweave.operators.ordered_hash import BASES, PRIME, combined, ordered_checksum, power, range_hashes
from poolweave.operators.ordering import sort_panel


def test_powers(spark):
    exponents = [0, 1, 255, 256, 65_535, 1 << 33, PRIME - 2]
    frame = spark.createDataFrame([(e,) for e in exponents], "e long").select("e", power(BASES[0], F.col("e")))
    assert dict(rows(frame)) == {e: pow(BASES[0], e, PRIME) for e in exponents}


def test_ordered_checksum_knows_the_order_only(spark):
    data = [(k % 3, k, f"v{k % 7}") for k in range(400)]
    frame = spark.createDataFrame(data, "g int, k int, v string")

    def checksums(df, partitions):
        ordered = sort_panel(df, ["k"], ["g"], partitions=partitions)
        return rows(ordered_checksum(ordered, ["g"], ["v"]))

    one = checksums(frame, 1)
    assert all(checksums(frame, n) == one for n in (2, 5, 13))
    # Two rows swapped; the set of rows stays.
    swapped = frame.withColumn("k", F.when(F.col("k") == 3, 9).when(F.col("k") == 9, 3).otherwise(F.col("k")))
    other = checksums(swapped, 5)
    assert [a == b for a, b in zip(one, other)] == [False, True, True]
    text = quality.row_checksum(frame, ["g"], ["v"])
    assert rows(text) == rows(quality.row_checksum(swapped, ["g"], ["v"]))
    # Stored ranges and later ones behind them.
    parts = [frame.filter("k < 150"), frame.filter("k >= 150")]
    hashes = [range_hashes(sort_panel(p, ["k"], ["g"], partitions=3), ["g"], ["v"]) for p in parts]
    later = hashes[1].withColumn("task", F.col("task") + 1000)
    assert rows(combined(hashes[0].unionAll(later), ["g"])) == one
    assert rows(ordered_checksum(frame.filter("k < 0"), ["g"])) == []


@pytest.mark.parametrize(("parts", "cells"), [(4, 120), (2, 9), (1, 3)])
def test_reconciliation(spark, parts, cells):
    """Sketches that hold the differences, or none of them: always the rows of a full comparison."""
    rng = random.Random(parts)
    before = [(rng.choice(["a", "b", None, ""]), rng.randrange(400)) for _ in range(1500)]
    after = [r for r in before if r[1] % 29] + [("new", 1)] * 3 + before[:5]
    left, right = (spark.createDataFrame(x, "t string, k int") for x in (before, after))
    expected = rows(quality.row_differences(left, right))
    assert rows(reconcile.reconciled_differences(left, right.select("k", "t"), parts, cells), "t", "k", "copies_before", "copies_after") == expected
    assert reconcile.reconciled_differences(left, left, parts, cells).count() == 0


def test_only_differing_rows_move(spark):
    left = spark.range(20_000).select((F.col("id") % 5000).alias("k"), F.col("id").cast("string").alias("t"))
    right = left.filter("t NOT IN ('17', '4711')").unionAll(left.filter("t = '9'"))
    sketch = reconcile.difference_sketch(left, right)
    assert sketch.count() <= 3 * 3  # three cells for each difference, whatever the rows
    found = reconcile.peeled(sketch)
    assert found.filter("hash IS NULL").count() == 0
    assert rows(reconcile.differing_rows(left, found, ["k", "t"]), "t") == [("17",), ("4711",), ("9",)]
    with pytest.raises(ValueError, match="different columns"):
        reconcile.reconciled_differences(left, right.select("k"))


def test_checks_agree_in_sql_and_python(spark):
    numbers = [0, 1, (1 << 31) - 1, 1 << 31, reconcile.PRIME - 1, 123_456_789_012_345_678]
    frame = spark.createDataFrame([(n,) for n in numbers], "n long").select(
        "n", reconcile._check_column(F.col("n")), reconcile._cells(F.col("n"), 99)
    )
    for n, check, cells in frame.collect():
        assert check == reconcile._check(n) and list(cells) == reconcile._cells_of(n, 99)


def test_exact_counts_have_no_expand(spark):
    frame = spark.createDataFrame([(1, "a", None), (1, "a", "x"), (1, None, ""), (2, None, None)], "g int, p string, q string")
    counted = quality.distinct_values(frame, ["g"], ["p", "q"])
    assert rows(counted) == [(1, 1, 2), (2, 0, 0)]
    report = quality.integrity_report(frame, frame, ["g"], keys=["p", "q"], columns=["p", "q"])
    for df in (counted, report):
        assert "Expand" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert rows(report, "g", "status", "rows_before", "unique_keys") == [(1, "PASS", 3, 2), (2, "PASS", 1, 0)]


def test_values_travel_without_checksums(spark):
    frame = spark.createDataFrame([(1, "a", "x"), (1, "b", None), (None, "c", "y")], "g int, p string, q string")
    report = quality.integrity_report(frame, frame.filter("p <> 'b'"), ["g"], keys=["p", "q"], columns=["p", "q"])
    plan = report._jdf.queryExecution().executedPlan().toString()
    carried = re.findall(r"keys=\[[^\]]*value#\d+\], functions=\[([^\]]*)\]", plan)
    assert len(carried) == 4 and not any(carried)
    assert rows(report, "g", "status", "rows_before", "rows_after") == [(1, "FAIL", 2, 1), (None, "PASS", 1, 1)]


def test_month_bits(spark):
    rng = random.Random(7)
    months = [f"{y}-{m:02d}" for y in (1999, 2005, 2024) for m in range(1, 13)] + ["0001-01", "9999-12", "1970-04", "1975-08"]
    data = [(rng.randrange(4), rng.choice(["ECB", "ESMA"]), rng.choice(months)) for _ in range(300)]
    data += [(9, s, m) for m in months for s in ("ECB", "ESMA")]
    frame = spark.createDataFrame(data, "p int, source string, date_ym string")
    bits = pools.merged_bits(pools.month_bits(frame.filter("p < 2 OR source = 'ECB'"), ["p"]).unionAll(
        pools.month_bits(frame.filter("NOT (p < 2 OR source = 'ECB')"), ["p"])), ["p"])
    assert rows(pools.overlap_of_bits(bits, ["p"])) == rows(pools.overlap_report(frame, ["p"]))
    assert bits.count() < frame.select("p", "date_ym").distinct().count() / 2
    odd = spark.createDataFrame([(1, s, m) for s in ("ECB", "ESMA") for m in ("", "2020", "2020-13", None)], frame.schema)
    assert rows(pools.overlap_of_bits(pools.month_bits(odd, ["p"]), ["p"])) == []


def test_evidence_merges_with_late_rows(spark):
    data = [("A", 5, None, "DE1"), ("A", 7, "fr", None), ("B", 3, "x", "ND9"), ("RMBMIT1", 1, None, None), ("C", 2, "PT", "IT3")]
    late = [("A", 1, "es", None), ("B", 4, None, "BE2"), ("C", 9, "GR", None), ("D", 1, None, None)]
    schema = "pool_id string, position long, RREL81 string, RREC6 string"
    old, new = (spark.createDataFrame(x, schema) for x in (data, late))
    merged = country.merged_evidence([country.country_evidence(x) for x in (old, new)])
    assert rows(country.country_of_evidence(merged)) == rows(country.detect_country(old.unionAll(new)))
    assert ("SPAIN",) in rows(country.country_of_evidence(merged, aliases={"ES": "SPAIN"}), "country")
    # A late batch without one of the columns fits, too.
    narrow = country.country_evidence(new.drop("RREC6"))
    both = country.merged_evidence([country.country_evidence(old), narrow])
    expected = country.detect_country(old.unionByName(new.drop("RREC6"), allowMissingColumns=True))
    assert rows(country.country_of_evidence(both)) == rows(expected)


def test_sketches_of_partitions_unite(spark):
    frame = spark.range(30_000).select(
        (F.col("id") % 6).alias("pool"), F.when(F.col("id") % 5 > 0, F.col("id") % 3000).alias("v"), F.lit("c").alias("w")
    )
    stored = sketches.distinct_sketches(frame, ["pool"], ["v", "w"])
    assert stored.count() == 12
    by_country = stored.withColumn("country", F.col("pool") % 2).drop("pool")
    found = {(c, n): (r, d) for c, n, r, d in rows(sketches.estimates(by_country, ["country"]))}
    exact = rows(frame.groupBy((F.col("pool") % 2).alias("country")).agg(F.count_distinct("v"), F.count_distinct("w")))
    for country, v, w in exact:
        assert found[country, "w"] == (15_000, w) and abs(found[country, "v"][1] - v) <= 0.04 * v
