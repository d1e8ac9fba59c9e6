"""Where intermediate tables go."""

from types import SimpleNamespace

import pytest

from poolweave.session import materialize, scratch_path, shared_folder


def test_the_named_folder_is_used(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    assert scratch_path(spark, "x").startswith(f"{folder}/poolweave/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_a_session_without_one_gets_its_own(tmp_path):
    unset = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: default),
        sparkContext=SimpleNamespace(applicationId="app-1", master="local[4]"),
    )
    assert shared_folder(unset) == shared_folder(unset)
    assert "poolweave-app-1-" in shared_folder(unset)


def test_a_cluster_must_name_its_folder():
    cluster = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: default),
        sparkContext=SimpleNamespace(applicationId="app-2", master="local-cluster[3,2,1000]"),
    )
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(cluster)


def test_materialize_keeps_rows_and_schema(spark):
    df = spark.range(5).selectExpr("id", "cast(null as string) AS `odd name`")
    copy = materialize(df)
    assert copy.schema.names == df.schema.names
    assert sorted(copy.collect()) == sorted(df.collect())
    assert "FileScan parquet" in copy._jdf.queryExecution().executedPlan().toString()
