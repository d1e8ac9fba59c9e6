"""Queries of stage 3: countries of pools, statistics, column unions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poolweave.catalog import views as v
from poolweave.catalog.registry import query
from poolweave.operators.columns import align, header_union
from poolweave.operators.country import (
    country_evidence,
    country_of_evidence,
    country_statistics,
    detect_country,
    first_rows,
    merged_evidence,
)
from poolweave.operators.skew import lookup_join
from poolweave.session import materialize

_CODE = r"regexp_matches({0}, '^\p{{L}}{{2}}$')"


def _detected(source: str, exclude_nd: str = "FALSE") -> str:
    code = {c: f"""min_by("{c}", position) FILTER (WHERE {_CODE.format(f'"{c}"')})"""
            for c in ("RREL81", "RREL84", "NPEL20")}
    region = r"""min_by(substr("{0}", 1, 2), position)
      FILTER (WHERE regexp_matches("{0}", '^\p{{L}}{{2}}') AND NOT ({1} AND "{0}" LIKE 'ND%'))"""
    return rf"""
SELECT pool_id, upper(coalesce({code["RREL81"]}, {code["RREL84"]},
  {region.format("RREC6", exclude_nd)}, {region.format("RREL11", "TRUE")},
  {region.format("AR129", "TRUE")}, {code["NPEL20"]},
  CASE WHEN regexp_matches(pool_id, '^RMB[MS]')
       AND regexp_matches(substr(pool_id, 5, 2), '^\p{{L}}+$')
       THEN substr(pool_id, 5, 2) END,
  'UNKNOWN')) AS country
FROM ({source}) GROUP BY pool_id
"""


@query(_detected(v.GEOGRAPHY))
def country_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect_country(v.geography(spark, sf_dir), sample_rows=None)


@query(_detected(v.GEOGRAPHY))
def country_of_merged_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from the stored evidence of early rows and that of rows that came later."""
    rows = v.geography(spark, sf_dir)
    late = F.col("position") % 3 == 0
    stored = [materialize(country_evidence(rows.filter(c)), "evidence") for c in (~late, late)]
    return country_of_evidence(merged_evidence(stored))


_FIRST_THREE = f"""
SELECT * FROM ({v.GEOGRAPHY})
QUALIFY row_number() OVER (PARTITION BY pool_id ORDER BY position) <= 3
"""


@query(_detected(_FIRST_THREE))
def country_detect_sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect_country(v.geography(spark, sf_dir), sample_rows=3)


@query(_detected(v.GEOGRAPHY, "TRUE"))
def country_detect_without_nd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect_country(
        v.geography(spark, sf_dir), sample_rows=None, exclude_no_data_everywhere=True
    )


@query(
    f"""
SELECT pool_id, CASE country WHEN 'DE' THEN 'GERMANY' WHEN 'ND' THEN 'NO DATA' ELSE country END
  AS country FROM ({_detected(v.GEOGRAPHY)})
"""
)
def country_detect_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect_country(
        v.geography(spark, sf_dir),
        sample_rows=None,
        aliases={"DE": "GERMANY", "ND": "NO DATA"},
    )


@query(_FIRST_THREE)
def first_rows_per_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_rows(v.geography(spark, sf_dir), ["pool_id"], ["position"], 3)


_INDEX = """
SELECT upper(right(n_name, 2)) AS country,
  CASE c_custkey % 3 WHEN 0 THEN 'matched' WHEN 1 THEN 'ecb_only' ELSE 'esma_only' END AS bucket,
  c_custkey * 100 AS length, c_mktsegment
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = F.col("c_custkey")
    joined = lookup_join(
        v.table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "n_nationkey"),
        v.table(spark, sf_dir, "nation"),
        ["n_nationkey"],
        "inner",
        null_safe=False,
    )
    return joined.select(
        F.upper(F.right("n_name", F.lit(2))).alias("country"),
        F.when(customer % 3 == 0, "matched")
        .when(customer % 3 == 1, "ecb_only")
        .otherwise("esma_only")
        .alias("bucket"),
        (customer * 100).alias("length"),
        "c_mktsegment",
    )


@query(
    f"""
SELECT country, count(*) AS files, CAST(sum(length) AS BIGINT) AS bytes,
  count(*) FILTER (WHERE bucket = 'matched') AS matched,
  count(*) FILTER (WHERE bucket = 'ecb_only') AS ecb_only,
  count(*) FILTER (WHERE bucket = 'esma_only') AS esma_only
FROM ({_INDEX}) GROUP BY country
"""
)
def country_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return country_statistics(_index(spark, sf_dir))


@query(
    f"""
WITH names AS (
  SELECT country, c_mktsegment AS n FROM ({_INDEX})
  UNION SELECT country, bucket FROM ({_INDEX}) UNION SELECT country, 'RREL3' FROM ({_INDEX}))
SELECT country, string_agg(n, ',' ORDER BY n) AS columns, count(*) AS width
FROM names GROUP BY country
"""
)
def country_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    header = F.array("c_mktsegment", "bucket", F.lit("RREL3"))
    headers = _index(spark, sf_dir).withColumn("header", header)
    return header_union(headers, ["country"]).select(
        "country", F.array_join("columns", ",").alias("columns"), F.size("columns").cast("long").alias("width")
    )


@query(
    f"""
WITH countries AS ({_detected(v.GEOGRAPHY)})
SELECT p.*, NULL::VARCHAR AS "RREL99", coalesce(c.country, 'UNKNOWN') AS country FROM (
  SELECT CASE WHEN pool_no = 10 THEN 'RMBMIT0010' ELSE 'POOL' || CAST(pool_no AS VARCHAR) END
    AS pool_id, "RREL3", "RREC3", "RREL6", source FROM ({v.PANEL})) p
LEFT JOIN countries c ON c.pool_id = p.pool_id
"""
)
def country_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panel rows with the country of their pool, under a wider column list."""
    countries = materialize(detect_country(v.geography(spark, sf_dir), sample_rows=None))
    panel = v.panel(spark, sf_dir).withColumn(
        "pool_id",
        F.when(F.col("pool_no") == 10, "RMBMIT0010").otherwise(
            F.concat(F.lit("POOL"), v.text("pool_no"))
        ),
    )
    joined = lookup_join(panel, countries, ["pool_id"], "left").withColumn(
        "country", F.coalesce("country", F.lit("UNKNOWN"))
    )
    columns = ["RREC3", "RREL3", "RREL6", "RREL99", "country", "pool_id", "source"]
    return align(joined, columns)


@query(
    f"""
SELECT count(DISTINCT country) AS countries, count(*) AS files,
  CAST(sum(length) AS BIGINT) AS bytes FROM ({_INDEX})
"""
)
def grand_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_country = country_statistics(_index(spark, sf_dir))
    return per_country.agg(
        F.count(F.lit(1)).alias("countries"),
        F.sum("files").alias("files"),
        F.sum("bytes").alias("bytes"),
    )
