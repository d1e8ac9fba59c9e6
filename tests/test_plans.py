"""Plans stay native, prune columns, push filters, and avoid needless shuffles."""

import pytest

from poolweave.catalog import QUERIES, views
from poolweave.operators.country import detect_country
from poolweave.operators.mapping import prepare_ecb
from poolweave.operators.pools import overlap_report
from poolweave.operators.prefer import covered_keys, prefer_source
from poolweave.operators.quality import loan_checksum, unique_keys

TABLES = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def logical_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plans_are_native(spark, name):
    plan = plan_of(QUERIES[name](spark, TABLES))
    for foreign in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert foreign not in plan


def test_the_dedup_is_one_anti_join_with_aggregated_keys(spark):
    panel = views.panel(spark, TABLES)
    spark.sparkContext.setJobGroup("dedup", "")
    plan = plan_of(prefer_source(panel, ["pool_no"]))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # Nothing runs while the query is built.
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("dedup")
    assert plan.count("LeftAnti") == 1
    key_side = plan.split("LeftAnti", 1)[1]
    assert "HashAggregate" in key_side


def test_key_pass_reads_key_columns_only(spark):
    panel = views.panel(spark, TABLES)
    plan = plan_of(covered_keys(panel, ["pool_no"]))
    assert plan.count("Exchange hashpartitioning") == 1
    for unused in ("l_extendedprice", "l_partkey", "l_linestatus"):
        assert unused not in plan
    # One shuffle on (pool, month) serves both sources.
    assert plan_of(overlap_report(panel, ["pool_no"])).count("Exchange hashpartitioning") == 2


def test_pool_list_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "landed")
    panel = views.panel(spark, TABLES)
    panel.withColumn("pool_id", panel.pool_no.cast("string")).drop("pool_no").write.parquet(path)
    landed = spark.read.parquet(path)
    listed = covered_keys(landed.filter(landed.pool_id.isin("1", "2")), ["pool_id"])
    assert "In(pool_id, [1,2])" in plan_of(listed)


def test_rename_collapses_into_one_projection(spark):
    renamed = prepare_ecb(views.ecb_rows(spark, TABLES), views.DOCUMENTED_CODES)
    assert logical_of(renamed).count("Project") <= 2


def test_country_needs_one_shuffle_without_sampling(spark):
    plan = plan_of(detect_country(views.geography(spark, TABLES), sample_rows=None))
    assert plan.count("Exchange hashpartitioning") == 1
    sampled = plan_of(detect_country(views.geography(spark, TABLES), sample_rows=3))
    assert "WindowGroupLimit" in sampled


def test_groups_are_combined_before_they_move(spark):
    panel = views.panel(spark, TABLES)
    assert "partial_sum" in plan_of(loan_checksum(panel, ["pool_no"]))
    distinct = plan_of(unique_keys(panel, ["pool_no"]))
    assert "__key" in distinct and "partial_count" in distinct
