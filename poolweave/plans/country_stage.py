"""Stages 3 and 4: pools to countries, countries sorted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poolweave.functions.columns import SORT_KEYS, cols, present
from poolweave.operators.country import country_statistics, detect_country
from poolweave.operators.ordering import sort_panel
from poolweave.operators.skew import lookup_join
from poolweave.plans.universe_stage import POOL
from poolweave.session import materialize
from poolweave.sources.tables import partition_files

# ECB rows come before ESMA rows in a pool, then files and rows in storage order.
POOL_ORDER = ("source", "file_name", "block_start", "row_place")
STORAGE_COLUMNS = ("file_name", "block_start", "row_place", "date_ym")
COLUMN_ORDER_TAIL = ("bucket", "pool_id", "country")


def pool_countries(panel: DataFrame, **options) -> DataFrame:
    """``pool_id, bucket, country``; an id may occur in two buckets."""
    return detect_country(panel, POOL, present(panel, POOL_ORDER), **options)


def country_panel(panel: DataFrame, countries: DataFrame | None = None, **options) -> DataFrame:
    """All pools with their ``country``, columns in sorted order."""
    if countries is None:
        countries = materialize(pool_countries(panel, **options), "countries")
    with_country = lookup_join(panel, countries, POOL, "left")
    names = sorted(set(with_country.columns) - set(STORAGE_COLUMNS) - set(COLUMN_ORDER_TAIL))
    return with_country.select(*cols([*names, *COLUMN_ORDER_TAIL]))


def country_index(spark: SparkSession, pools_path: str, countries: DataFrame) -> DataFrame:
    """Statistics per country from the pool table's files."""
    files = (
        partition_files(spark, pools_path, "bucket", "pool_id")
        .groupBy(*POOL)
        .agg(F.sum("length").alias("length"))
    )
    return country_statistics(files.join(countries, list(POOL)))


def sorted_countries(
    panel: DataFrame, keys: Sequence[str] = SORT_KEYS, **options
) -> DataFrame:
    """Rows of all countries in (country, loan, collateral, date) order."""
    return sort_panel(panel, keys, ["country"], **options)
