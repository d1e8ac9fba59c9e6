"""Session settings and the shared folder for intermediate results."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# AQE splits skewed shuffle partitions and sizes the rest at run time; header
# names are told apart by case; dates are compared as text, so the zone is fixed.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.caseSensitive": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def build_session(app_name: str = "poolweave", **settings: str) -> SparkSession:
    """A session with the settings the four stages expect.

    Master, memory and shuffle partitions come from the cluster's own
    configuration unless given here.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it.

    Only a local session without one (a test) gets a temporary folder of its own; on a
    cluster every executor would write to its own disk there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    master = spark.sparkContext.master
    if not re.match(r"local(\[|$)", master):
        raise ValueError(f"spark.checkpoint.dir must name a shared folder for master {master}")
    return _test_folder(spark.sparkContext.applicationId)


@cache
def _test_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"poolweave-{application}-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/poolweave/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` to the shared folder once and go on from the written table.

    Later steps read the table instead of repeating the work before it, its size
    is known to the optimizer, and a lost executor costs a re-read only.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
