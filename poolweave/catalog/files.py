"""Queries of file operators, on trees of files that are written from the tables first.

A file holds the rows of one pool and month, or of one pair, so files become more and not
larger with the tables.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from poolweave.catalog import views as v
from poolweave.catalog.harmonise import TEMPLATE_FORWARD
from poolweave.catalog.registry import query
from poolweave.operators.mapping import forward_mapping
from poolweave.operators.ordering import sort_panel
from poolweave.plans.checks import check_order
from poolweave.plans.collateral_stage import JoinedPairs, join_pairs
from poolweave.plans.universe_stage import EcbRows, read_ecb
from poolweave.session import materialize, scratch_path
from poolweave.sinks.tables import export_csv, write_sorted
from poolweave.sources.lookups import read_pool_mapping, read_template
from poolweave.sources.manifest import list_files, unread_files, with_headers
from poolweave.sources.one_scan import Place, scan_once

CRC_ERROR, NOT_GZIP = "CRC check failed", "Not a gzipped file"


def _write(spark: SparkSession, contents: DataFrame, name: str) -> str:
    """One file for each row of ``contents`` (name, content), written by tasks."""
    folder = scratch_path(spark, name)
    place = folder.split(":", 1)[-1] if folder.startswith("file:") else folder
    place = "/" + place.lstrip("/") if "://" not in place else place

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = fs.FileSystem.from_uri(place) if "://" in place else (fs.LocalFileSystem(), place)
        store.create_dir(root)
        for batch in batches:
            for row in batch.itertuples():
                with store.open_output_stream(f"{root}/{row.name}", compression=None) as out:
                    out.write(bytes(row.content))
            yield batch[["name"]]

    contents.mapInPandas(write, "name string").count()
    return folder


def _text_files(rows: DataFrame, name: Column, header: Column, line: Column) -> DataFrame:
    """``name, text`` with a header line and the lines of each file."""
    lines = rows.select(name.alias("name"), header.alias("header"), line.alias("line"))
    body = F.array_join(F.sort_array(F.collect_list("line")), "\n")
    return lines.groupBy("name", "header").agg(body.alias("body")).select(
        "name", F.concat("header", F.lit("\n"), "body", F.lit("\n")).alias("text")
    )


def _file_name() -> Column:
    return F.concat(F.lit("pool"), v.text("pool_no"), F.lit("_"), F.col("date_ym"))


@query(
    f"""
SELECT "RREL3", CASE WHEN pool_no % 3 = 0 THEN "RREC3" END AS "RREC3",
  CASE WHEN pool_no % 3 < 2 THEN "RREL6" END AS "RREL6",
  CASE WHEN pool_no % 3 = 1 THEN l_linestatus END AS "STATUS",
  CASE WHEN pool_no % 3 = 2 THEN CAST(l_partkey AS VARCHAR) END AS "PART",
  'pool' || CAST(pool_no AS VARCHAR) || '_' || date_ym || '.csv' AS file_name
FROM ({v.PANEL})
"""
)
def scan_of_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of three headers, in other orders and with other columns, in one scan."""
    kind = F.col("pool_no") % 3
    header = F.when(kind == 0, "RREL3,RREC3,RREL6").when(kind == 1, "RREL6,STATUS,RREL3").otherwise("PART,RREL3")
    line = (
        F.when(kind == 0, F.concat_ws(",", "RREL3", "RREC3", "RREL6"))
        .when(kind == 1, F.concat_ws(",", "RREL6", F.concat(F.lit('"'), "l_linestatus", F.lit('"')), "RREL3"))
        .otherwise(F.concat_ws(",", v.text("l_partkey"), "RREL3"))
    )
    texts = _text_files(v.panel(spark, sf_dir), F.concat(_file_name(), F.lit(".csv")), header, line)
    folder = _write(spark, texts.select("name", F.encode("text", "utf-8").alias("content")), "mixed-headers")
    files = materialize(with_headers(list_files(spark, folder), folder), "manifest")
    return scan_once(Place(folder), files).select("RREL3", "RREC3", "RREL6", "STATUS", "PART", "file_name")


_POOL = "CAST(k % 7 AS VARCHAR)"
_DATE = "'2020-' || lpad(CAST(1 + (k // 7) % 12 AS VARCHAR), 2, '0') || '-28'"
_FILE_PAIRS = f"""
SELECT "RREL2", CASE WHEN k % 7 % 2 = 0 THEN "RREL3" END AS "RREL3", u."NOTE", "RREC2", "RREC3",
  c."NOTE" AS "NOTE_collateral", 'P' || {_POOL} AS pool_id,
  '1_RMB_UE_Collateral_P' || {_POOL} || '_' || {_DATE} || '_1.csv' AS merged_name
FROM (SELECT CAST("RREL2" AS BIGINT) AS k, * FROM ({v.LOANS})) u LEFT JOIN ({v.COLLATERAL}) c ON "RREL2" = "RREC2"
WHERE k % 7 <> 6
"""


def _pairs(spark: SparkSession, sf_dir: str) -> JoinedPairs:
    """Loan files of two headers and their collateral files; pool 6 has no collateral."""

    def name(kind: str, key: Column) -> Column:
        month = F.lpad((1 + F.floor(key / 7) % 12).cast("string"), 2, "0")
        return F.concat(F.lit(f"1_RMB_{kind}_P"), (key % 7).cast("string"), F.lit("_2020-"), month, F.lit("-28_1.csv"))

    key, own = F.col("RREL2").cast("long"), F.col("RREC2").cast("long")
    even = key % 7 % 2 == 0
    loan, customer, note = (F.coalesce(c, F.lit("")) for c in ("RREL2", "RREL3", "NOTE"))
    line = F.when(even, F.concat_ws(",", loan, customer, note)).otherwise(F.concat_ws(",", note, loan))
    header = F.when(even, "RREL2,RREL3,NOTE").otherwise("NOTE,RREL2")
    ue = _text_files(v.loans(spark, sf_dir), name("UE", key), header, line)
    line = F.concat_ws(",", "RREC2", "Sec_Id", "RREC3", "NOTE", "RREC1")
    collateral = v.collateral(spark, sf_dir).filter(own % 7 != 6)
    other = _text_files(collateral, name("Collateral", own), F.lit("RREC2,Sec_Id,RREC3,NOTE,RREC1"), line)
    texts = ue.unionAll(other).select("name", F.encode("text", "utf-8").alias("content"))
    return join_pairs(spark, _write(spark, texts, "pair-files"))


@query(_FILE_PAIRS)
def pairs_of_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loan files joined to their collateral files, as stage 1 does it."""
    columns = ("RREL2", "RREL3", "NOTE", "RREC2", "RREC3", "NOTE_collateral", "pool_id", "merged_name")
    return _pairs(spark, sf_dir).rows.select(*columns)


@query(
    f"""
WITH c AS (SELECT "RREC2", count(*) AS n FROM ({v.COLLATERAL}) GROUP BY "RREC2"),
u AS (SELECT k, k % 7 AS pool, {_DATE} AS date, coalesce(n, 0) AS n
  FROM (SELECT CAST("RREL2" AS BIGINT) AS k FROM ({v.LOANS})) LEFT JOIN c ON CAST(k AS VARCHAR) = "RREC2"),
own AS (SELECT k % 7 AS pool, {_DATE} AS date, count(*) AS collateral_rows
  FROM (SELECT CAST("RREC2" AS BIGINT) AS k FROM ({v.COLLATERAL})) GROUP BY ALL)
SELECT '1_RMB_UE_Collateral_P' || CAST(pool AS VARCHAR) || '_' || date || '_1.csv' AS filename, count(*) AS ue_rows,
  any_value(collateral_rows) AS collateral_rows, CAST(sum(greatest(n, 1)) AS BIGINT) AS merged_rows,
  CAST(sum(n) AS BIGINT) AS matched_rows, count(*) FILTER (WHERE n = 0) AS unmatched_rows,
  'RREL2=RREC2' AS merge_keys, CAST(CASE WHEN pool % 2 = 0 THEN 6 ELSE 5 END AS INTEGER) AS merged_cols
FROM u JOIN own USING (pool, date) WHERE pool <> 6 GROUP BY pool, date
"""
)
def statistics_of_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics of each pair of files."""
    return _pairs(spark, sf_dir).statistics.drop("asset_type")


def _gzip_name(ending: str = ".gz") -> Column:
    return F.concat(F.lit("ECB"), v.text("pool_no"), F.lit("_"), F.col("date_ym"), F.lit(ending))


def _ecb(spark: SparkSession, sf_dir: str) -> tuple[str, EcbRows]:
    """Gzip files of the ECB codes: June of pool 3 has a wrong checksum, July of pool 4 is
    no gzip, August of pool 5 has another ending, and pool 6 has an empty file."""
    month = F.substring("date_ym", 6, 2)
    other = (F.col("pool_no") == 5) & (month == "08")
    name = F.when(other, _gzip_name(".txt")).otherwise(_gzip_name())
    texts = _text_files(v.panel(spark, sf_dir), name, F.lit("AR1,AR2"), F.concat_ws(",", "RREL6", "RREL3"))

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            contents = [gzip.compress(t.encode()) for t in batch["text"]]
            for k, n in enumerate(batch["name"]):
                if n.startswith("ECB3_") and n.endswith("-06.gz"):
                    contents[k] = contents[k][:-8] + b"0000" + contents[k][-4:]
                if n.startswith("ECB4_") and n.endswith("-07.gz"):
                    contents[k] = b"not gzip"
            yield pd.DataFrame({"name": batch["name"], "content": contents})

    contents = texts.mapInPandas(packed, "name string, content binary")
    empty = spark.createDataFrame([("ECB6_empty.gz", b"")], "name string, content binary")
    folder = _write(spark, contents.unionAll(empty), "ecb-files")
    return folder, read_ecb(spark, folder, {"AR1": "RREL6", "AR2": "RREL3"})


@query(
    f"""
SELECT 'ECB' || CAST(pool_no AS VARCHAR) AS pool_id, "RREL6", "RREL3", date_ym, 'ECB' AS source,
  pool_no = 3 AND date_ym LIKE '%-06' AS salvaged FROM ({v.PANEL})
WHERE NOT (pool_no = 4 AND date_ym LIKE '%-07') AND NOT (pool_no = 5 AND date_ym LIKE '%-08')
"""
)
def rows_of_gzip_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ECB rows of sound files in one scan, and what can be read of a damaged one."""
    rows = _ecb(spark, sf_dir)[1].rows
    return rows.select("pool_id", "RREL6", "RREL3", "date_ym", "source", "salvaged")


@query(
    f"""
WITH files AS (SELECT DISTINCT pool_no, date_ym FROM ({v.PANEL}))
SELECT 'ECB' || CAST(pool_no AS VARCHAR) || '_' || date_ym || CASE WHEN pool_no = 5 THEN '.txt' ELSE '.gz' END AS name,
  CASE pool_no WHEN 3 THEN '{CRC_ERROR}' WHEN 4 THEN '{NOT_GZIP}' ELSE 'Name of another form' END AS error
FROM files WHERE (pool_no = 3 AND date_ym LIKE '%-06') OR (pool_no = 4 AND date_ym LIKE '%-07')
  OR (pool_no = 5 AND date_ym LIKE '%-08')
UNION ALL SELECT 'ECB6_empty.gz', 'Empty file'
"""
)
def quarantined_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged, misnamed and empty files with the reason."""
    folder, ecb = _ecb(spark, sf_dir)
    unread = unread_files(spark, folder, r"^.+\.gz$").select("path", "error")
    both = ecb.quarantined.select("path", "error").unionAll(unread)
    return both.select(F.regexp_extract("path", "([^/]+)$", 1).alias("name"), "error")


@query(
    f"""
SELECT CAST(pool_no AS VARCHAR) AS country, count(*) AS rows, CAST(0 AS BIGINT) AS violations, 'PASS' AS status
FROM ({v.PANEL_WITH_NULLS}) GROUP BY pool_no
"""
)
def order_of_stored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sorted output is written per country and checked as it is stored."""
    panel = v.panel_with_nulls(spark, sf_dir).withColumn("country", v.text("pool_no"))
    path = scratch_path(spark, "sorted-output")
    write_sorted(sort_panel(panel, group=["country"]), path)
    return check_order(spark, path)


@query(
    f"""
SELECT CAST(pool_no AS VARCHAR) AS pool, count(*) AS rows, CASE WHEN pool_no % 2 = 0
  THEN 'RREC3,RREL3,RREL6,l_linestatus' ELSE 'RREL3,RREL6' END AS header
FROM ({v.PANEL}) GROUP BY pool_no
"""
)
def exported_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV per pool with its own non-empty columns, read back by header line."""
    even = F.col("pool_no") % 2 == 0
    rows = v.panel(spark, sf_dir).select(
        v.text("pool_no").alias("pool"), "RREL3", "RREL6",
        *(F.when(even, F.col(c)).alias(c) for c in ("RREC3", "l_linestatus")), F.lit(None).cast("string").alias("empty"),
    )
    path = scratch_path(spark, "export")
    export_csv(rows, path, "pool")
    files = materialize(with_headers(list_files(spark, path, "part-*.csv"), path, "part-*.csv"), "export-files")
    pool = F.regexp_extract("path", "pool=([^/]+)/", 1).alias("pool")
    headers = files.groupBy(pool).agg(F.min("header_line").alias("header"))
    counts = spark.read.option("recursiveFileLookup", True).text(path).select(
        F.regexp_extract("_metadata.file_path", "pool=([^/]+)/", 1).alias("pool"), "value"
    )
    return counts.join(headers, "pool").filter("value <> header").groupBy("pool", "header").agg(F.count(F.lit(1)).alias("rows"))


@query(TEMPLATE_FORWARD)
def template_of_a_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forward mapping from a template saved as CSV."""
    titles = ("FIELD CODE", "FIELD NAME", "For info: existing ECB or EBA NPL template field code")
    sheet = v.template(spark, sf_dir).orderBy("position").select(
        *(F.col(c).alias(t) for c, t in zip(("esma_code", "esma_name", "ecb_code"), titles))
    )
    path = scratch_path(spark, "template")
    sheet.coalesce(1).write.option("header", True).option("escape", '"').csv(path)
    return forward_mapping(read_template(spark, path))


@query(f"SELECT * FROM ({v.POOL_MAPPING})")
def mapping_of_a_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pool mapping from its JSON document."""
    pools = F.map_from_entries(F.collect_list(F.struct("ecb_pool_id", F.struct(F.col("esma_pool_id").alias("esma_pool")))))
    path = scratch_path(spark, "mapping")
    v.pool_mapping(spark, sf_dir).agg(pools.alias("pools")).coalesce(1).write.json(path)
    return read_pool_mapping(spark, path)
