"""Queries of stage 2: mapping, pools, dedup, column sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poolweave.catalog import views as v
from poolweave.catalog.registry import query
from poolweave.operators.columns import non_empty_columns, union_aligned
from poolweave.operators.mapping import (
    forward_mapping,
    prepare_ecb,
    prepare_esma,
    reverse_mapping,
)
from poolweave.operators.pools import (
    classify_pools,
    large_pools,
    merged_bits,
    month_bits,
    overlap_of_bits,
    overlap_report,
    pending,
    pool_sizes,
    shared_periods,
)
from poolweave.operators.prefer import prefer_source, removal_report
from poolweave.plans.universe_stage import universe
from poolweave.session import materialize, scratch_path
from poolweave.streaming.incremental import process_available

MATCHED_POOLS = [0, 1, 2, 3, 4, 5]
LISTED_POOLS = [1, 4]


def _kept(source: str, restriction: str = "TRUE", equal: str = "=") -> str:
    return f"""
WITH panel AS ({source}),
esma AS (SELECT DISTINCT pool_no, "RREL3", date_ym FROM panel WHERE source = 'ESMA')
SELECT p.* FROM panel p
WHERE p.source = 'ESMA' OR NOT ({restriction}) OR NOT EXISTS (
  SELECT 1 FROM esma e WHERE e.pool_no = p.pool_no
    AND e."RREL3" {equal} p."RREL3" AND e.date_ym {equal} p.date_ym)
"""


@query(_kept(v.PANEL, "p.pool_no IN (0, 1, 2, 3, 4, 5)"))
def prefer_esma(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefer_source(v.panel(spark, sf_dir), ["pool_no"], overlap_pools=MATCHED_POOLS)


@query(_kept(v.PANEL, "p.pool_no IN (1, 4)"))
def prefer_esma_listed_pools(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefer_source(v.panel(spark, sf_dir), ["pool_no"], overlap_pools=LISTED_POOLS)


@query(_kept(v.PANEL_WITH_NULLS, equal="IS NOT DISTINCT FROM"))
def prefer_esma_nullsafe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefer_source(v.panel_with_nulls(spark, sf_dir), ["pool_no"])


@query(
    _kept(
        v.PANEL,
        """p.pool_no IN (SELECT a.pool_no FROM panel a JOIN panel b
           ON a.pool_no = b.pool_no AND a.date_ym = b.date_ym
           WHERE a.source = 'ECB' AND b.source = 'ESMA')""".replace(
            "FROM panel a JOIN panel b",
            "FROM (SELECT DISTINCT pool_no, date_ym, source FROM panel) a "
            "JOIN (SELECT DISTINCT pool_no, date_ym, source FROM panel) b",
        ),
    )
)
def prefer_esma_derived_pools(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = v.panel(spark, sf_dir)
    overlap = overlap_report(panel, ["pool_no"]).select("pool_no")
    return prefer_source(panel, ["pool_no"], overlap_pools=overlap)


@query(_kept(v.PANEL))
def prefer_esma_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dedup of every pool as an incremental run over the landed file."""
    output = scratch_path(spark, "incremental")
    process_available(
        spark,
        sf_dir,
        f"{output}/pools",
        f"{output}/progress",
        ["pool_no"],
        prepare=v.panel_of,
        names="lineitem.parquet",
    ).awaitTermination()
    written = spark.read.parquet(f"{output}/pools")
    return written.withColumn("pool_no", F.col("pool_no").cast("long"))


@query(
    f"""
WITH panel AS ({v.PANEL}),
esma AS (SELECT DISTINCT pool_no, "RREL3", date_ym FROM panel WHERE source = 'ESMA'),
flagged AS (
  SELECT p.pool_no, p.source = 'ECB' AND e.pool_no IS NOT NULL AS gone
  FROM panel p LEFT JOIN esma e ON e.pool_no = p.pool_no AND e."RREL3" = p."RREL3"
    AND e.date_ym = p.date_ym)
SELECT pool_no, count(*) AS rows_before, count(*) FILTER (WHERE NOT gone) AS rows_after,
  count(*) FILTER (WHERE gone) AS rows_removed
FROM flagged GROUP BY pool_no
"""
)
def dedup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_report(v.panel(spark, sf_dir), ["pool_no"])


_OVERLAP = f"""
WITH keys AS (SELECT DISTINCT pool_no, date_ym, source FROM ({v.PANEL}))
SELECT a.pool_no, count(*) AS months, min(a.date_ym) AS first_month, max(a.date_ym) AS last_month
FROM keys a JOIN keys b ON a.pool_no = b.pool_no AND a.date_ym = b.date_ym
WHERE a.source = 'ECB' AND b.source = 'ESMA' GROUP BY a.pool_no
"""


@query(_OVERLAP)
def overlap_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap_report(v.panel(spark, sf_dir), ["pool_no"])


@query(_OVERLAP)
def overlap_months_of_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from stored bits of two parts of the panel."""
    panel = v.panel(spark, sf_dir)
    parts = [month_bits(panel.filter(c), ["pool_no"]) for c in ("l_partkey % 2 = 0", "l_partkey % 2 <> 0")]
    states = materialize(parts[0].unionAll(parts[1]), "month-bits")
    return overlap_of_bits(merged_bits(states, ["pool_no"]), ["pool_no"])


@query(
    f"""
WITH keys AS (SELECT DISTINCT pool_no, "RREL3", source FROM ({v.PANEL}))
SELECT a.pool_no, count(*) AS loans
FROM keys a JOIN keys b ON a.pool_no = b.pool_no AND a."RREL3" = b."RREL3"
WHERE a.source = 'ECB' AND b.source = 'ESMA' GROUP BY a.pool_no
"""
)
def overlap_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared = shared_periods(v.panel(spark, sf_dir), ["pool_no"], "RREL3")
    return shared.groupBy("pool_no").agg(F.count(F.lit(1)).alias("loans"))


_CLASSIFIED = f"""
mapping AS ({v.POOL_MAPPING}),
ecb AS (SELECT DISTINCT pool_id FROM ({v.ECB_ROWS})),
esma AS (SELECT DISTINCT pool_id FROM ({v.ESMA_ROWS})),
pools AS (
  SELECT ecb_pool_id, esma_pool_id, 'matched' AS bucket FROM mapping
  UNION ALL SELECT pool_id, NULL, 'ecb_only' FROM ecb
    WHERE pool_id NOT IN (SELECT ecb_pool_id FROM mapping)
  UNION ALL SELECT NULL, pool_id, 'esma_only' FROM esma
    WHERE pool_id NOT IN (SELECT esma_pool_id FROM mapping))
"""


@query(f"WITH {_CLASSIFIED} SELECT ecb_pool_id, esma_pool_id, bucket FROM pools")
def pool_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_pools(
        v.ecb_rows(spark, sf_dir), v.esma_rows(spark, sf_dir), v.pool_mapping(spark, sf_dir)
    )


@query(
    f"""
WITH files AS (SELECT *, split_part(name, '_', 4) AS pool_id FROM ({v.FILE_NAMES}))
SELECT pool_id, count(*) AS files, CAST(sum(length) AS BIGINT) AS bytes,
  sum(length) > 100000000 AS is_large
FROM files GROUP BY pool_id
"""
)
def pool_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = v.file_names(spark, sf_dir).withColumn("pool_id", F.split("name", "_")[3])
    return pool_sizes(files, threshold=100_000_000)


_SIZES = "SELECT pool_id, count(*) * 1000 > {} AS is_large FROM ({}) GROUP BY pool_id"


@query(
    f"""
WITH {_CLASSIFIED},
a AS ({_SIZES.format(5_300_000, v.ECB_ROWS)}), b AS ({_SIZES.format(2_600_000, v.ESMA_ROWS)})
SELECT p.*, coalesce(a.is_large, FALSE) OR coalesce(b.is_large, FALSE) AS is_large
FROM pools p LEFT JOIN a ON a.pool_id = p.ecb_pool_id LEFT JOIN b ON b.pool_id = p.esma_pool_id
"""
)
def pool_large_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pools with a large side, each row standing for a file of 1000 bytes."""
    ecb, esma = v.ecb_rows(spark, sf_dir), v.esma_rows(spark, sf_dir)
    length = F.lit(1000).cast("long")
    return large_pools(
        classify_pools(ecb, esma, v.pool_mapping(spark, sf_dir)),
        pool_sizes(ecb.withColumn("length", length), threshold=5_300_000),
        pool_sizes(esma.withColumn("length", length), threshold=2_600_000),
    )


TEMPLATE_FORWARD = f"""
WITH ranked AS (
  SELECT ecb_code, esma_code, position, contains(esma_name, 'New') AS newer,
    row_number() OVER (PARTITION BY ecb_code ORDER BY position) AS place
  FROM ({v.TEMPLATE}) WHERE ecb_code IS NOT NULL)
SELECT ecb_code, coalesce(arg_max(esma_code, position) FILTER (WHERE newer),
  max(esma_code) FILTER (WHERE place = 1)) AS esma_code
FROM ranked GROUP BY ecb_code
"""


@query(TEMPLATE_FORWARD)
def template_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forward_mapping(v.template(spark, sf_dir))


@query(
    f"""
SELECT esma_code, arg_max(ecb_code, position) AS ecb_code
FROM ({v.TEMPLATE}) WHERE ecb_code IS NOT NULL GROUP BY esma_code
"""
)
def template_reverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reverse_mapping(v.template(spark, sf_dir))


@query(
    f"""
SELECT pool_id, "AR1" AS "RREL6", "AR2" AS "RREL3", "AR128" AS "RREC6", "RREC3", "AR7",
  'ECB' AS source, substr("AR1", 1, 7) AS date_ym
FROM ({v.ECB_ROWS})
"""
)
def ecb_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_ecb(v.ecb_rows(spark, sf_dir), v.DOCUMENTED_CODES)


@query(
    f"""
SELECT pool_id, "AR1", "AR2" AS "RREL3", "AR128", "RREC3", "AR7",
  'ECB' AS source, substr("AR1", 1, 7) AS date_ym
FROM ({v.ECB_ROWS})
"""
)
def ecb_rename_without_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_ecb(v.ecb_rows(spark, sf_dir), {"AR2": "RREL3"})


@query(
    f"""
SELECT *, 'ESMA' AS source, substr("RREL6", 1, 7) AS date_ym FROM ({v.ESMA_ROWS})
"""
)
def esma_prepare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_esma(v.esma_rows(spark, sf_dir))


@query(
    f"""
WITH ecb AS (SELECT pool_id, "AR1" AS "RREL6", "AR2" AS "RREL3", "AR128" AS "RREC6",
    "RREC3", "AR7" FROM ({v.ECB_ROWS}))
SELECT * FROM ecb UNION ALL BY NAME SELECT * FROM ({v.ESMA_ROWS})
"""
)
def union_of_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    ecb = prepare_ecb(v.ecb_rows(spark, sf_dir), v.DOCUMENTED_CODES)
    return union_aligned([ecb.drop("source", "date_ym"), v.esma_rows(spark, sf_dir)])


_EVIDENCE = ("RREL81", "RREL84", "RREC6", "RREL11", "AR129", "NPEL20")


@query(
    " UNION ALL ".join(
        f"""SELECT pool_id, '{c}' AS column_name, count("{c}") AS "values"
        FROM ({v.GEOGRAPHY}) GROUP BY pool_id HAVING count("{c}") > 0"""
        for c in _EVIDENCE
    )
)
def non_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return non_empty_columns(v.geography(spark, sf_dir).drop("position"), ["pool_id"])


@query(
    f"""
WITH {_CLASSIFIED},
ecb_rows AS (SELECT p.ecb_pool_id, p.esma_pool_id, p.bucket, "AR1" AS "RREL6",
    "AR2" AS "RREL3", "AR128" AS "RREC6", "RREC3", "AR7", 'ECB' AS source
  FROM ({v.ECB_ROWS}) r JOIN pools p ON p.ecb_pool_id = r.pool_id),
esma_rows AS (SELECT p.ecb_pool_id, p.esma_pool_id, p.bucket, "RREL6", "RREL3", "RREC3",
    "RREL81", "RREL4", 'ESMA' AS source
  FROM ({v.ESMA_ROWS}) r JOIN pools p ON p.esma_pool_id = r.pool_id),
covering AS (SELECT DISTINCT ecb_pool_id, "RREL3", substr("RREL6", 1, 7) AS month FROM esma_rows),
kept AS (
  SELECT e.* FROM ecb_rows e LEFT JOIN covering c ON c.ecb_pool_id = e.ecb_pool_id
    AND c."RREL3" = e."RREL3" AND c.month = substr(e."RREL6", 1, 7)
  WHERE c.ecb_pool_id IS NULL OR e.ecb_pool_id NOT IN ('ECB0', 'ECB2'))
SELECT *, coalesce(ecb_pool_id, esma_pool_id) AS pool_id FROM (
  SELECT * FROM kept UNION ALL BY NAME SELECT * FROM esma_rows)
"""
)
def pool_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pools of both sources, with dedup in two of the matched ones."""
    return universe(
        prepare_ecb(v.ecb_rows(spark, sf_dir), v.DOCUMENTED_CODES),
        prepare_esma(v.esma_rows(spark, sf_dir)),
        v.pool_mapping(spark, sf_dir),
        overlap_pools=["ECB0", "ECB2"],
    )


@query(
    f"""
WITH items AS (SELECT DISTINCT pool_no, date_ym FROM ({v.PANEL})),
done AS (SELECT DISTINCT pool_no, date_ym FROM ({v.PANEL}) WHERE substr(date_ym, 7, 1) < '5')
SELECT i.* FROM items i LEFT JOIN done d ON i.pool_no = d.pool_no AND i.date_ym = d.date_ym
WHERE d.pool_no IS NULL
"""
)
def resume_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["pool_no", "date_ym"]
    panel = v.panel(spark, sf_dir)
    done = panel.filter(F.substring("date_ym", 7, 1) < "5")
    return pending(panel.select(*keys).distinct(), done, keys)
