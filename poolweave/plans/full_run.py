"""All four stages over a raw file tree."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poolweave.functions.names import FILE_NAME_PATTERN, ecb_pool_id, safe_pool_id
from poolweave.operators.collateral import batch_summary
from poolweave.operators.columns import non_empty_columns
from poolweave.operators.mapping import as_dict, forward_mapping
from poolweave.operators.pools import pending
from poolweave.operators.quality import row_counts
from poolweave.plans.collateral_stage import join_pairs
from poolweave.plans.country_stage import (
    country_index,
    country_panel,
    pool_countries,
    sorted_countries,
)
from poolweave.plans.universe_stage import (
    KNOWN_OVERLAP_POOLS,
    POOL,
    esma_from_pairs,
    pool_signatures,
    read_ecb,
    universe,
)
from poolweave.session import materialize
from poolweave.sinks.tables import (
    write_countries,
    write_pairs,
    write_pools,
    write_sorted,
    write_statistics,
)
from poolweave.sources.manifest import unread_files
from poolweave.sources.lookups import read_pool_mapping, read_template
from poolweave.sources.tables import output_sizes, partition_files, read_table


# Stored bytes per sorted range: about one output file, and well within a task's memory.
GZIP_NAME = r"^.+\.gz$"
RANGE_BYTES = 128 * 1024 * 1024


@dataclass(frozen=True)
class Inputs:
    esma_folder: str
    ecb_folder: str
    template: str
    pool_mapping: str


@dataclass(frozen=True)
class Outputs:
    """Tables below one folder."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def merged(self) -> str:
        return self.path("esma_merged")

    @property
    def pools(self) -> str:
        return self.path("pools")

    @property
    def pool_signatures(self) -> str:
        return self.path("pool_signatures")

    @property
    def country_inputs(self) -> str:
        return self.path("country_inputs")

    @property
    def sorted_inputs(self) -> str:
        return self.path("sorted_inputs")

    @property
    def countries(self) -> str:
        return self.path("countries")

    @property
    def sorted(self) -> str:
        return self.path("sorted")


def run(
    spark: SparkSession,
    inputs: Inputs,
    outputs: Outputs,
    *,
    overlap_pools: Sequence[str] | str = KNOWN_OVERLAP_POOLS,
    resume: bool = False,
) -> None:
    """Run the stages in order, each from the table the one before wrote.

    Without ``resume`` every table is replaced. With it, pools are left alone whose output
    was made of the rows they have now (a partition is visible only when it is complete),
    and so are countries made of such pools. A file that arrives, goes or changes has its
    pool and that pool's country written again.
    """
    run_collateral(spark, inputs, outputs)
    run_universe(spark, inputs, outputs, overlap_pools=overlap_pools, resume=resume)
    run_countries(spark, outputs, resume=resume)
    run_sort(spark, outputs, resume=resume)


def run_collateral(spark: SparkSession, inputs: Inputs, outputs: Outputs) -> None:
    joined = join_pairs(spark, inputs.esma_folder)
    if joined.rows is not None:
        write_pairs(joined.rows, outputs.merged)
    write_statistics(joined.statistics, outputs.path("esma_merged_statistics"))
    write_statistics(joined.failed, outputs.path("esma_merged_failed"))
    unread = unread_files(spark, inputs.esma_folder, FILE_NAME_PATTERN)
    write_statistics(unread, outputs.path("esma_quarantine"))
    write_statistics(
        batch_summary(joined.statistics, joined.failed), outputs.path("esma_merged_summary")
    )


def run_universe(
    spark: SparkSession,
    inputs: Inputs,
    outputs: Outputs,
    *,
    overlap_pools: Sequence[str] | str = KNOWN_OVERLAP_POOLS,
    resume: bool = False,
) -> None:
    mapping = read_pool_mapping(spark, inputs.pool_mapping)
    codes = as_dict(forward_mapping(read_template(spark, inputs.template)))
    ecb = read_ecb(spark, inputs.ecb_folder, codes)
    esma = esma_from_pairs(spark.read.parquet(outputs.merged))
    signatures = materialize(pool_signatures(ecb.rows, esma, mapping), "pool-signatures")
    done = finished_pools(spark, outputs, signatures) if resume else None
    panel = universe(ecb.rows, esma, mapping, overlap_pools=overlap_pools, finished=done)
    write_pools(panel, outputs.pools, replace=done is None)
    signatures.write.mode("overwrite").parquet(outputs.pool_signatures)
    unread = unread_files(spark, inputs.ecb_folder, GZIP_NAME).withColumn("pool_id", ecb_pool_id(F.col("name")))
    quarantined = ecb.quarantined.unionByName(unread.select("path", "pool_id", "error"))
    write_statistics(quarantined, outputs.path("quarantine"))
    write_statistics(universe_summary(spark, outputs, signatures), outputs.path("universe_summary"))


def finished_pools(spark: SparkSession, outputs: Outputs, signatures: DataFrame) -> DataFrame | None:
    """Pools whose output was made of the rows they have now.

    ``None`` means that all are to be written: before the first run, and when a stored
    pool should not be there any more.
    """
    there = finished(spark, outputs.pools, *POOL)
    made_of = stored_or_none(spark, outputs.pool_signatures)
    if there is None or made_of is None:
        return None
    if not pending(there, signatures, POOL).isEmpty():
        return None
    return there.join(made_of.join(signatures, [*POOL, "signature"]), [*POOL], "left_semi")


def universe_summary(spark: SparkSession, outputs: Outputs, signatures: DataFrame) -> DataFrame:
    """Pools, finished pools, files and bytes of every bucket."""
    expected = signatures.groupBy("bucket").agg(F.count(F.lit(1)).alias("pools"))
    stored = partition_files(spark, outputs.pools, *POOL).groupBy("bucket").agg(
        F.count_distinct("pool_id").alias("finished"), F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )
    counts = ("pools", "finished", "files", "bytes")
    return expected.join(stored, "bucket", "full").select("bucket", *(F.coalesce(c, F.lit(0)).alias(c) for c in counts))


def run_countries(spark: SparkSession, outputs: Outputs, *, resume: bool = False) -> None:
    panel = read_table(spark, outputs.pools)
    countries = materialize(pool_countries(panel), "countries")
    rows = country_panel(panel, countries)
    inputs = materialize(_country_inputs(spark, outputs, countries), "country-inputs")
    todo = outdated(spark, inputs, outputs.countries, outputs.country_inputs, resume)
    if todo is None:
        write_countries(rows, outputs.countries)
    elif todo:
        write_countries(rows.filter(F.col("country").isin(todo)), outputs.countries, replace=False)
    inputs.write.mode("overwrite").parquet(outputs.country_inputs)
    write_statistics(countries, outputs.path("pool_countries"))
    write_statistics(merge_log(spark, outputs, countries), outputs.path("merge_log"))
    write_statistics(
        country_index(spark, outputs.pools, countries), outputs.path("country_statistics")
    )


def merge_log(spark: SparkSession, outputs: Outputs, countries: DataFrame) -> DataFrame:
    """Pools, rows, columns with values and bytes per country, and whether all is there.

    A country without stored rows stays in the log as failed.
    """
    table = read_table(spark, outputs.countries)
    pools = countries.groupBy("country").agg(F.count(F.lit(1)).alias("files_merged"))
    sizes = output_sizes(spark, outputs.countries, "country").select("country", "bytes")
    values = [c for c in table.columns if c != "country"]
    filled = non_empty_columns(table, ["country"]).groupBy("country").agg(F.count(F.lit(1)).alias("columns"))
    counted = row_counts(table, ["country"]).withColumnRenamed("rows", "total_rows")
    return (
        pools.join(counted, "country", "full")
        .join(sizes, "country", "left")
        .join(filled, "country", "left")
        .withColumn("table_columns", F.lit(len(values)))
        .withColumn(
            "status",
            F.when(F.col("total_rows").isNull(), "failed")
            .when(F.col("files_merged").isNull(), "unexpected")
            .otherwise("success"),
        )
    )


def run_sort(spark: SparkSession, outputs: Outputs, *, resume: bool = False) -> None:
    """Sort all countries, or with ``resume`` those whose pools differ from the sorted ones.

    Writes ``sort_status``: rows before and after, and success, failed or skipped.
    """
    table = read_table(spark, outputs.countries)
    inputs = stored_or_none(spark, outputs.country_inputs)
    todo = None if inputs is None else outdated(spark, inputs, outputs.sorted, outputs.sorted_inputs, resume)
    rows = table if todo is None else table.filter(F.col("country").isin(todo))
    stored = output_sizes(spark, outputs.countries, "country").agg(F.sum("bytes")).first()[0]
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (stored or 0) // RANGE_BYTES)
    if todo is None or todo:
        ordered = sorted_countries(rows, partitions=ranges)
        write_sorted(ordered, outputs.sorted, replace=todo is None)
    if inputs is not None:
        inputs.write.mode("overwrite").parquet(outputs.sorted_inputs)
    write_statistics(sort_status(spark, outputs, todo), outputs.path("sort_status"))


def sort_status(spark: SparkSession, outputs: Outputs, todo: list[str] | None) -> DataFrame:
    """``country, rows_before, rows_after, status`` of every country."""
    before = row_counts(read_table(spark, outputs.countries), ["country"])
    after = row_counts(read_table(spark, outputs.sorted), ["country"])
    joined = before.withColumnRenamed("rows", "rows_before").join(
        after.withColumnRenamed("rows", "rows_after"), "country", "full"
    )
    skipped = F.lit(False) if todo is None else ~F.col("country").isin(todo)
    return joined.withColumn(
        "status",
        F.when(~F.col("rows_before").eqNullSafe(F.col("rows_after")), "failed")
        .when(skipped, "skipped")
        .otherwise("success"),
    )


def _country_inputs(spark: SparkSession, outputs: Outputs, countries: DataFrame) -> DataFrame:
    """``country, pool_id, bucket, signature``: what each country is made of."""
    pools = countries.select("country", *POOL).withColumn("pool_id", safe_pool_id(F.col("pool_id")))
    made_of = stored_or_none(spark, outputs.pool_signatures)
    if made_of is None:
        return pools.withColumn("signature", F.lit(""))
    return pools.join(made_of, [*POOL], "left").select("country", *POOL, F.coalesce("signature", F.lit("")).alias("signature"))


def outdated(
    spark: SparkSession, expected: DataFrame, path: str, recorded: str, resume: bool
) -> list[str] | None:
    """Countries that are not made of what ``expected`` says (country, pool_id, bucket, signature).

    ``recorded`` is where the last run noted that. ``None`` means all, with the whole
    table to be replaced: without ``resume``, before the first run, and when a stored
    country should not be there any more.
    """
    if not resume or finished(spark, path, "country") is None:
        return None
    stored = stored_or_none(spark, recorded)
    if stored is None:
        return None
    key = ["country", *POOL, "signature"]
    late = pending(expected, stored, key).select("country")
    gone = pending(stored, expected, key).select("country")
    changed = {r.country for r in late.unionAll(gone).distinct().collect()}  # countries are few
    there = {r.country for r in expected.select("country").distinct().collect()}
    return None if changed - there else sorted(changed)


def stored_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """A table of an earlier run, read at once; ``None`` where there is none."""
    try:
        return materialize(spark.read.parquet(path), "stored")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def finished(spark: SparkSession, path: str, *partitions: str) -> DataFrame | None:
    """Partitions that have output already; ``None`` before the first run."""
    try:
        return partition_files(spark, path, *partitions).select(*partitions).distinct()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
