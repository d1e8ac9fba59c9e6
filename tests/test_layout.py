"""Tables laid out by key, counts from footers, damaged output."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from poolweave.operators.collateral import join_collateral
from poolweave.plans.checks import check_sorted_output
from poolweave.sinks.clustered import join_clustered, write_clustered
from poolweave.sources.footers import counting_plan, damaged_files, footer_counts


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_clustered_join_has_no_exchange(spark, strings):
    loans = strings("RREL2 NOTE", *((str(k % 90), f"n{k}") for k in range(200)), (None, "x"))
    collateral = strings("RREC2 RREC1 NOTE", *((str(k), "c", f"m{k}") for k in range(0, 120, 2)), (None, "c", "y"))
    for name, df, key in (("clustered_loans", loans, "RREL2"), ("clustered_collateral", collateral, "RREC2")):
        write_clustered(df.filter("NOTE < 'n5'"), name, key, 4)
        write_clustered(df.filter("NOTE >= 'n5'"), name, key, 4, mode="append")
    try:
        joined = join_clustered(spark, "clustered_loans", "clustered_collateral")
        assert "Exchange" not in plan_of(joined)
        expected = join_collateral(loans, collateral)
        assert joined.columns == expected.columns and rows(joined) == rows(expected)
        balanced = join_clustered(spark, "clustered_loans", "clustered_collateral", hot_rows=2)
        assert rows(balanced.select(*joined.columns)) == rows(expected)
        with pytest.raises(ValueError, match="No join key"):
            join_clustered(spark, "clustered_loans", "clustered_loans")
    finally:
        for name in ("clustered_loans", "clustered_collateral"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_counts_from_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select((F.col("id") % 3).alias("p"), "id").write.partitionBy("p").parquet(path)
    assert rows(footer_counts(spark, path, "p")) == rows(spark.read.parquet(path).groupBy("p").count())
    plan = plan_of(counting_plan(spark, path, "p"))
    assert "COUNT(*)" in plan and "PushedGroupBy" in plan and "id#" not in plan
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def test_unreadable_country_is_an_error(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("countries", "sorted")]
    table = spark.createDataFrame(
        [(c, str(k), "1", "2020-01-01") for c in ("AA", "BB", "CC") for k in range(5)], "country string, RREL3 string, RREC3 string, RREL6 string"
    )
    for path in paths:
        table.coalesce(1).write.partitionBy("country").parquet(path)
    assert {r.status for r in check_sorted_output(spark, *paths).collect()} == {"PASS"}
    [broken] = (tmp_path / "sorted" / "country=BB").glob("part-*.parquet")
    broken.write_bytes(broken.read_bytes()[:-9])
    (broken.parent / f".{broken.name}.crc").unlink(missing_ok=True)
    assert damaged_files(spark, paths[1], "country").count() == 1
    report = {r.country: r for r in check_sorted_output(spark, *paths).collect()}
    assert {c: r.status for c, r in report.items()} == {"AA": "PASS", "BB": "ERROR", "CC": "PASS"}
    assert report["BB"].issues == ["ERROR: Not a Parquet file"] and report["BB"].rows_before is None
    assert [r.country for r in check_sorted_output(spark, *paths, countries=["AA"]).collect()] == ["AA"]
