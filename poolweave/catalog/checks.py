"""Queries of stage 4 and of the checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poolweave.catalog import views as v
from poolweave.catalog.registry import query
from poolweave.operators import quality as q
from poolweave.operators.ordering import with_position
from poolweave.plans.checks import duplicates_on, largest_pools_on, one_series

DATE = "1998-06-15"
CHUNK_ROWS = 1_000  # so that violations at the borders of chunks occur

_SORT = '"RREL3" NULLS LAST, "RREC3" NULLS LAST, "RREL6" NULLS LAST'
_TIES = "date_ym NULLS LAST, l_extendedprice, l_linestatus, l_partkey, l_quantity, source"


@query(
    f"""
SELECT *, row_number() OVER (PARTITION BY pool_no ORDER BY {_SORT}, {_TIES}) AS position
FROM ({v.PANEL_WITH_NULLS})
"""
)
def sorted_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with their place in the order of the sorted output."""
    return with_position(v.panel_with_nulls(spark, sf_dir), group=["pool_no"])


SORT_AND_TIES = f"{_SORT}, {_TIES}"
_DATE_ORDER = '"RREL6" NULLS LAST, "RREL3" NULLS LAST, "RREC3" NULLS LAST'


@query(
    f"""
WITH stored AS (
  SELECT *, lag("RREL3") OVER w AS p3, lag("RREC3") OVER w AS pc, lag("RREL6") OVER w AS p6
  FROM ({v.PANEL_WITH_NULLS})
  WINDOW w AS (PARTITION BY pool_no ORDER BY {_DATE_ORDER}, {_TIES}))
SELECT pool_no, count(*) AS rows, count(*) FILTER (WHERE p3 IS NOT NULL AND (
    "RREL3" < p3 OR ("RREL3" = p3 AND "RREC3" < pc)
    OR ("RREL3" = p3 AND "RREC3" = pc AND "RREL6" < p6))) AS violations
FROM stored GROUP BY pool_no
"""
)
def sort_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel as if stored by date, checked for loan order."""
    stored = with_position(
        v.panel_with_nulls(spark, sf_dir), ["RREL6", "RREL3", "RREC3"], ["pool_no"]
    )
    chunked = stored.withColumn("chunk", F.floor(F.col("position") / CHUNK_ROWS))
    return q.sort_violations(chunked, ["pool_no"], ["chunk"], ["position"])


@query(f"SELECT pool_no, count(*) AS rows FROM ({v.PANEL}) GROUP BY pool_no")
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.row_counts(v.panel(spark, sf_dir), ["pool_no"])


@query(
    f"""
SELECT pool_no, count(DISTINCT "RREL3" || '|' || coalesce("RREC3", '') || '|'
  || coalesce("RREL6", '')) AS unique_keys
FROM ({v.PANEL_WITH_NULLS}) GROUP BY pool_no
"""
)
def unique_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.unique_keys(v.panel_with_nulls(spark, sf_dir), ["pool_no"])


@query(
    f"""
SELECT pool_no, count(DISTINCT "RREL3") AS "distinct_RREL3",
  count(DISTINCT "RREC3") AS "distinct_RREC3", count(DISTINCT "RREL6") AS "distinct_RREL6",
  count(DISTINCT source) AS distinct_source
FROM ({v.PANEL_WITH_NULLS}) GROUP BY pool_no
"""
)
def distinct_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.distinct_values(v.panel_with_nulls(spark, sf_dir), ["pool_no"])


_DIGEST = "CAST(CAST('0x' || substr(md5({0}), 1, 15) AS BIGINT) AS HUGEINT)"


@query(
    f"""
SELECT pool_no, count(*) AS rows, CAST(sum({_DIGEST.format("coalesce(\"RREL3\", '')")})
  AS VARCHAR) AS loan_checksum
FROM ({v.PANEL_WITH_NULLS}) GROUP BY pool_no
"""
)
def loan_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.loan_checksum(v.panel_with_nulls(spark, sf_dir), ["pool_no"])


def row_text_sql(*columns: str) -> str:
    return " || ".join(
        f"""CASE WHEN "{c}" IS NULL THEN '-;' ELSE CAST(length("{c}") AS VARCHAR)
        || ':' || "{c}" || ';' END"""
        for c in columns
    )


@query(
    f"""
SELECT pool_no, count(*) AS rows, CAST(sum({_DIGEST.format(row_text_sql("RREC3", "RREL3", "RREL6", "source"))})
  AS VARCHAR) AS row_checksum
FROM ({v.PANEL_WITH_NULLS}) GROUP BY pool_no
"""
)
def row_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.row_checksum(
        v.panel_with_nulls(spark, sf_dir), ["pool_no"], ["RREL3", "RREC3", "RREL6", "source"]
    )


@query(
    f"""
SELECT pool_no, "RREL3", "RREC3", count(*) AS cnt FROM ({v.PANEL})
GROUP BY ALL HAVING count(*) >= 2
"""
)
def dup_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.duplicate_groups(v.panel(spark, sf_dir), ["pool_no", "RREL3", "RREC3"], at_least=2)


_LISTED = f"""
SELECT CAST(pool_no AS VARCHAR) AS "RREL1", "RREL6" AS "Pool_Cutoff_Date", "RREL3",
  'DE' || CAST(l_partkey % 7 AS VARCHAR) AS "RREC6", source FROM ({v.PANEL})
"""


def _listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.panel(spark, sf_dir).select(
        v.text("pool_no").alias("RREL1"),
        F.col("RREL6").alias("Pool_Cutoff_Date"),
        "RREL3",
        F.concat(F.lit("DE"), (F.col("l_partkey") % 7).cast("string")).alias("RREC6"),
        "source",
    )


@query(
    f"""
SELECT *, count(*) AS cnt FROM ({_LISTED}) WHERE "Pool_Cutoff_Date" = '{DATE}'
GROUP BY ALL ORDER BY "RREL1", "RREL3", "RREC6", source LIMIT 50
"""
)
def rows_on_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates_on(_listed(spark, sf_dir), DATE)


@query(
    f"""
SELECT "RREL1", "Pool_Cutoff_Date", count(DISTINCT "RREL3") AS unique_loans,
  count(*) AS total_rows
FROM ({_LISTED}) WHERE "Pool_Cutoff_Date" = '{DATE}'
GROUP BY ALL ORDER BY total_rows DESC, "RREL1" LIMIT 10
"""
)
def pool_loans_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return largest_pools_on(_listed(spark, sf_dir), DATE)


# One series per supplier and group of parts, some of them observed on many dates.
_OBSERVED = """
SELECT CAST(l_suppkey AS VARCHAR) AS "RREL3",
  CASE WHEN l_linenumber < 7 THEN CAST(l_partkey % 200 AS VARCHAR) ELSE '' END AS "RREC3",
  substr(CAST(l_shipdate AS VARCHAR), 1, 10) AS "RREL6", CAST(l_orderkey AS VARCHAR) AS "RREL1"
FROM lineitem
"""


def _observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.table(spark, sf_dir, "lineitem").select(
        v.text("l_suppkey").alias("RREL3"),
        F.when(F.col("l_linenumber") < 7, (F.col("l_partkey") % 200).cast("string"))
        .otherwise("")
        .alias("RREC3"),
        v.day("l_shipdate").alias("RREL6"),
        v.text("l_orderkey").alias("RREL1"),
    )


_LONG = f"""
SELECT "RREL3", "RREC3", count(*) AS obs FROM ({_OBSERVED})
WHERE "RREL3" <> '' AND "RREC3" <> '' GROUP BY ALL HAVING count(*) > 3
"""


@query(f"SELECT o.* FROM ({_OBSERVED}) o SEMI JOIN ({_LONG}) USING (\"RREL3\", \"RREC3\")")
def loan_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of series with more than three observations."""
    observed = _observed(spark, sf_dir)
    return q.series_rows(observed, q.long_series(observed), ["RREL3", "RREC3"])


@query(
    f"""
SELECT o.* FROM ({_OBSERVED}) o SEMI JOIN (
  SELECT * FROM ({_LONG}) ORDER BY "RREL3", "RREC3" LIMIT 1) USING ("RREL3", "RREC3")
"""
)
def loan_series_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_series(_observed(spark, sf_dir))


# A damaged copy: rows lost in one pool, doubled in another, changed in a third; one
# pool is lost as a whole, and half of another comes back under a new number.
DAMAGED_COPY = f"""
SELECT "RREL3", "RREC3", CASE WHEN pool_no = 3 AND l_partkey % 50 = 0 THEN '1900-01-01'
  ELSE "RREL6" END AS "RREL6", source,
  CASE WHEN pool_no = 6 AND l_partkey % 2 = 0 THEN pool_no + 100 ELSE pool_no END AS pool_no
FROM ({v.PANEL}) p, (SELECT unnest([1, 2]) AS copy)
WHERE copy <= CASE WHEN pool_no = 5 THEN 0 WHEN pool_no = 1 AND l_partkey % 40 = 0 THEN 0
  WHEN pool_no = 2 AND l_partkey % 30 = 0 THEN 2 ELSE 1 END
"""
SOUND_COPY = f'SELECT "RREL3", "RREC3", "RREL6", source, pool_no FROM ({v.PANEL})'


def sound(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.panel(spark, sf_dir).select("RREL3", "RREC3", "RREL6", "source", "pool_no")


def damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    pool, part = F.col("pool_no"), F.col("l_partkey")
    copies = (
        F.when(pool == 5, 0)
        .when((pool == 1) & (part % 40 == 0), 0)
        .when((pool == 2) & (part % 30 == 0), 2)
        .otherwise(1)
    )
    return (
        v.panel(spark, sf_dir)
        .withColumn(
            "RREL6",
            F.when((pool == 3) & (part % 50 == 0), "1900-01-01").otherwise(F.col("RREL6")),
        )
        .withColumn("copy", F.explode(F.array_repeat(F.lit(1), copies)))
        .withColumn("pool_no", F.when((pool == 6) & (part % 2 == 0), pool + 100).otherwise(pool))
        .select("RREL3", "RREC3", "RREL6", "source", "pool_no")
    )


DIFFERENCES = f"""
WITH a AS (SELECT *, count(*) AS n FROM ({SOUND_COPY}) GROUP BY ALL),
b AS (SELECT *, count(*) AS n FROM ({DAMAGED_COPY}) GROUP BY ALL)
SELECT "RREL3", "RREC3", "RREL6", source, pool_no, coalesce(a.n, 0) AS copies_before,
  coalesce(b.n, 0) AS copies_after
FROM a FULL JOIN b USING ("RREL3", "RREC3", "RREL6", source, pool_no)
WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)
"""


@query(DIFFERENCES)
def input_output_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.row_differences(sound(spark, sf_dir), damaged(spark, sf_dir))


def _measured(source: str) -> str:
    keys = """"RREL3" || '|' || coalesce("RREC3", '') || '|' || coalesce("RREL6", '')"""
    return f"""
SELECT pool_no, count(*) AS rows, count(DISTINCT {keys}) AS unique_keys,
  count(DISTINCT "RREL3") AS d3, count(DISTINCT "RREC3") AS dc, count(DISTINCT "RREL6") AS d6,
  count(DISTINCT source) AS ds,
  sum({_DIGEST.format("coalesce(\"RREL3\", '')")}) AS loan,
  sum({_DIGEST.format(row_text_sql("RREC3", "RREL3", "RREL6", "source"))}) AS whole
FROM ({source}) GROUP BY pool_no
"""


_REPORT = f"""
WITH a AS ({_measured(SOUND_COPY)}), b AS ({_measured(DAMAGED_COPY)}),
issues AS (SELECT coalesce(a.pool_no, b.pool_no) AS pool_no, a.rows AS rows_before,
  b.rows AS rows_after, a.unique_keys,
  CASE WHEN b.rows IS NULL THEN 'ONLY IN INPUT' WHEN a.rows IS NULL THEN 'ONLY IN OUTPUT' ELSE
  concat_ws('; ',
    CASE WHEN a.rows <> b.rows THEN 'ROW COUNT MISMATCH' END,
    CASE WHEN a.unique_keys <> b.unique_keys THEN 'UNIQUE KEY COUNT MISMATCH' END,
    CASE WHEN a.d3 <> b.d3 THEN 'DISTINCT RREL3 MISMATCH' END,
    CASE WHEN a.dc <> b.dc THEN 'DISTINCT RREC3 MISMATCH' END,
    CASE WHEN a.d6 <> b.d6 THEN 'DISTINCT RREL6 MISMATCH' END,
    CASE WHEN a.ds <> b.ds THEN 'DISTINCT source MISMATCH' END,
    CASE WHEN a.loan <> b.loan THEN 'RREL3 CHECKSUM MISMATCH' END,
    CASE WHEN a.whole <> b.whole THEN 'ROW CHECKSUM MISMATCH' END) END AS issues
  FROM a FULL JOIN b ON a.pool_no = b.pool_no)
SELECT pool_no, CASE WHEN issues = '' THEN 'PASS' ELSE 'FAIL' END AS status, rows_before,
  rows_after, unique_keys, 5 AS columns, issues
FROM issues
"""


def _report(spark: SparkSession, sf_dir: str, pools: list[int] | None = None) -> DataFrame:
    report = q.integrity_report(
        sound(spark, sf_dir), damaged(spark, sf_dir), ["pool_no"], groups=pools
    )
    return report.withColumn("issues", F.array_join("issues", "; "))


@query(_REPORT)
def integrity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir)


@query(f"SELECT * FROM ({_REPORT}) WHERE pool_no IN (2, 7)")
def integrity_report_chosen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir, [2, 7])


@query(
    f"""
SELECT count(*) AS checked, count(*) FILTER (WHERE status = 'PASS') AS passed,
  count(*) FILTER (WHERE status <> 'PASS') AS failed,
  CAST(coalesce(sum(rows_before) FILTER (WHERE status = 'PASS'), 0) AS BIGINT) AS rows_verified
FROM ({_REPORT})
"""
)
def integrity_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.report_totals(_report(spark, sf_dir))


@query(
    f"""
SELECT p.* FROM ({v.PANEL}) p SEMI JOIN (
  SELECT "RREL3" FROM (SELECT DISTINCT "RREL3" FROM ({v.PANEL}))
  ORDER BY md5('2024' || "RREL3"), "RREL3" LIMIT 5) USING ("RREL3")
"""
)
def spot_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of five loans picked by hash."""
    panel = v.panel(spark, sf_dir)
    chosen = q.sample_values(panel, "RREL3", seed="2024")
    return q.series_rows(panel, chosen, ["RREL3"])


@query(
    f"""
SELECT "RREL3", "RREC3", "RREL6", pool_no FROM ({v.PANEL_WITH_NULLS})
ORDER BY {_SORT}, pool_no LIMIT 50
"""
)
def head_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v.panel_with_nulls(spark, sf_dir).select("RREL3", "RREC3", "RREL6", "pool_no")
    return q.head(rows, ["RREL3", "RREC3", "RREL6", "pool_no"], 50)
