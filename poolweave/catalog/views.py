"""Loan panels, files and pools derived from the test tables.

Every view exists twice, as a DataFrame and as SQL text with the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from poolweave.functions.names import month


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(name: str) -> Column:
    return F.col(name).cast("string")


def day(name: str) -> Column:
    return F.col(name).cast("date").cast("string")


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loan panel of two sources: pools 0-5 in both, 6-8 ECB only, 9-11 ESMA only."""
    return panel_of(table(spark, sf_dir, "lineitem"))


def panel_of(lineitem: DataFrame) -> DataFrame:
    pool = F.col("l_suppkey") % 12
    return lineitem.select(
        text("l_orderkey").alias("RREL3"),
        text("l_linenumber").alias("RREC3"),
        day("l_shipdate").alias("RREL6"),
        F.when(pool < 6, F.when(F.col("l_returnflag") == "N", "ESMA").otherwise("ECB"))
        .when(pool < 9, "ECB")
        .otherwise("ESMA")
        .alias("source"),
        pool.alias("pool_no"),
        "l_quantity",
        "l_extendedprice",
        "l_partkey",
        "l_linestatus",
    ).withColumn("date_ym", month(F.col("RREL6")))


PANEL = """
SELECT CAST(l_orderkey AS VARCHAR) AS "RREL3", CAST(l_linenumber AS VARCHAR) AS "RREC3",
  substr(CAST(l_shipdate AS VARCHAR), 1, 10) AS "RREL6",
  substr(CAST(l_shipdate AS VARCHAR), 1, 7) AS date_ym,
  CASE WHEN l_suppkey % 12 < 6 THEN CASE WHEN l_returnflag = 'N' THEN 'ESMA' ELSE 'ECB' END
       WHEN l_suppkey % 12 < 9 THEN 'ECB' ELSE 'ESMA' END AS source,
  l_suppkey % 12 AS pool_no, l_quantity, l_extendedprice, l_partkey, l_linestatus
FROM lineitem
"""


def panel_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel with some loans, collateral ids and dates missing."""
    part = F.col("l_partkey")
    return panel(spark, sf_dir).withColumns(
        {
            "RREL3": F.when(part % 97 != 0, F.col("RREL3")),
            "RREC3": F.when(part % 31 != 0, F.col("RREC3")),
            "RREL6": F.when(part % 53 != 0, F.col("RREL6")),
            "date_ym": F.when(part % 53 != 0, F.col("date_ym")),
        }
    )


PANEL_WITH_NULLS = f"""
SELECT CASE WHEN l_partkey % 97 <> 0 THEN "RREL3" END AS "RREL3",
  CASE WHEN l_partkey % 31 <> 0 THEN "RREC3" END AS "RREC3",
  CASE WHEN l_partkey % 53 <> 0 THEN "RREL6" END AS "RREL6",
  CASE WHEN l_partkey % 53 <> 0 THEN date_ym END AS date_ym,
  source, pool_no, l_quantity, l_extendedprice, l_partkey, l_linestatus
FROM ({PANEL})
"""


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loan rows (UE); ``NOTE`` clashes with the collateral."""
    return table(spark, sf_dir, "orders").select(
        text("o_orderkey").alias("RREL2"),
        F.when(F.col("o_orderkey") % 97 != 0, text("o_custkey")).alias("RREL3"),
        F.col("o_orderstatus").alias("RREL4"),
        F.lit("S1").alias("Sec_Id"),
        day("o_orderdate").alias("Pool_Cutoff_Date"),
        F.col("o_orderpriority").alias("NOTE"),
    )


LOANS = """
SELECT CAST(o_orderkey AS VARCHAR) AS "RREL2",
  CASE WHEN o_orderkey % 97 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS "RREL3",
  o_orderstatus AS "RREL4", 'S1' AS "Sec_Id",
  substr(CAST(o_orderdate AS VARCHAR), 1, 10) AS "Pool_Cutoff_Date", o_orderpriority AS "NOTE"
FROM orders
"""


def collateral(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collateral rows; the first three metadata columns must not survive the join."""
    return table(spark, sf_dir, "lineitem").select(
        text("l_orderkey").alias("RREC2"),
        text("l_linenumber").alias("RREC3"),
        F.lit("S1").alias("Sec_Id"),
        F.lit("X").alias("Pool_Cutoff_Date"),
        F.lit("C").alias("RREC1"),
        F.col("l_linestatus").alias("NOTE"),
    )


COLLATERAL = """
SELECT CAST(l_orderkey AS VARCHAR) AS "RREC2", CAST(l_linenumber AS VARCHAR) AS "RREC3",
  'S1' AS "Sec_Id", 'X' AS "Pool_Cutoff_Date", 'C' AS "RREC1", l_linestatus AS "NOTE"
FROM lineitem
"""


def paired_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loan rows of many file pairs, with some join keys missing."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.floor(key / 500).alias("pair_no"),
        F.when(key % 250 != 0, text("o_orderkey")).alias("NPEL2"),
        F.col("o_orderstatus").alias("NPEL4"),
    )


PAIRED_LOANS = """
SELECT CAST(floor(o_orderkey / 500) AS BIGINT) AS pair_no,
  CASE WHEN o_orderkey % 250 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS "NPEL2",
  o_orderstatus AS "NPEL4"
FROM orders
"""


def paired_collateral(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("l_orderkey")
    return table(spark, sf_dir, "lineitem").select(
        F.floor(key / 500).alias("pair_no"),
        F.when(key % 250 != 0, text("l_orderkey")).alias("NPEC2"),
        text("l_linenumber").alias("NPEC3"),
    )


PAIRED_COLLATERAL = """
SELECT CAST(floor(l_orderkey / 500) AS BIGINT) AS pair_no,
  CASE WHEN l_orderkey % 250 <> 0 THEN CAST(l_orderkey AS VARCHAR) END AS "NPEC2",
  CAST(l_linenumber AS VARCHAR) AS "NPEC3"
FROM lineitem
"""


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names of several asset types, some with another form."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    status = F.col("o_orderstatus")
    name = F.concat(
        F.lit("1_"),
        F.when(status == "F", "RMB").when(status == "O", "NPE").otherwise("CRP_X"),
        F.lit("_"),
        F.when(key % 2 == 0, "UE").otherwise("Collateral"),
        F.lit("_POOL"),
        (customer % 50).cast("string"),
        F.when(key % 11 == 0, "_B").otherwise(""),
        F.lit("_"),
        F.substring(day("o_orderdate"), 1, 7),
        F.lit("-28_"),
        text("o_orderkey"),
        F.when(key % 17 == 0, ".txt").otherwise(".csv"),
    )
    return table(spark, sf_dir, "orders").select(
        name.alias("name"), (F.col("o_custkey") * 1000).alias("length")
    )


FILE_NAMES = """
SELECT '1_' || CASE o_orderstatus WHEN 'F' THEN 'RMB' WHEN 'O' THEN 'NPE' ELSE 'CRP_X' END
  || '_' || CASE WHEN o_orderkey % 2 = 0 THEN 'UE' ELSE 'Collateral' END
  || '_POOL' || CAST(o_custkey % 50 AS VARCHAR)
  || CASE WHEN o_orderkey % 11 = 0 THEN '_B' ELSE '' END || '_'
  || substr(CAST(o_orderdate AS VARCHAR), 1, 7) || '-28_' || CAST(o_orderkey AS VARCHAR)
  || CASE WHEN o_orderkey % 17 = 0 THEN '.txt' ELSE '.csv' END AS name,
  o_custkey * 1000 AS length
FROM orders
"""

NAME_PATTERN = r"^1_(\w+)_(UE|Collateral)_(.+)_(\d{4}-\d{2}-\d{2})_(\d+)\.csv$"

PARSED_NAMES = f"""
SELECT name, length,
  regexp_extract(name, '{NAME_PATTERN}', 1) AS asset_type,
  regexp_extract(name, '{NAME_PATTERN}', 2) AS category,
  regexp_extract(name, '{NAME_PATTERN}', 3) AS identifier,
  regexp_extract(name, '{NAME_PATTERN}', 4) AS date,
  regexp_extract(name, '{NAME_PATTERN}', 5) AS sequence
FROM ({FILE_NAMES}) WHERE regexp_matches(name, '{NAME_PATTERN}')
"""


def geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country evidence per pool; every level of the priority decides some pool."""
    supplier, nation = F.col("s_suppkey"), F.col("s_nationkey")
    pool = supplier % 12
    country = nation.cast("string")
    return table(spark, sf_dir, "supplier").select(
        F.when(pool == 10, "RMBMIT0010")
        .otherwise(F.concat(F.lit("POOL"), pool.cast("string")))
        .alias("pool_id"),
        supplier.alias("position"),
        F.when(
            pool.isin(0, 1) & (supplier % 5 > 1),
            F.concat(F.char(65 + nation % 26), F.char(66 + supplier % 12)),
        ).alias("RREL81"),
        F.when(pool.isin(2, 3), F.concat(F.char(97 + nation % 26), F.lit("e"))).alias("RREL84"),
        F.when(
            pool.isin(4, 5),
            F.when(supplier % 2 == 0, "ND1").otherwise(F.concat(F.lit("DE"), country)),
        ).alias("RREC6"),
        F.when(
            pool.isin(6, 7),
            F.when(supplier < 20, "ND2").otherwise(F.concat(F.lit("IT"), country)),
        ).alias("RREL11"),
        F.when(pool == 8, "NL31").alias("AR129"),
        F.when(pool == 9, "PT").alias("NPEL20"),
    )


GEOGRAPHY = """
SELECT CASE WHEN s_suppkey % 12 = 10 THEN 'RMBMIT0010'
       ELSE 'POOL' || CAST(s_suppkey % 12 AS VARCHAR) END AS pool_id, s_suppkey AS position,
  CASE WHEN s_suppkey % 12 IN (0, 1) AND s_suppkey % 5 > 1
       THEN chr(CAST(65 + s_nationkey % 26 AS INT)) || chr(CAST(66 + s_suppkey % 12 AS INT))
       END AS "RREL81",
  CASE WHEN s_suppkey % 12 IN (2, 3)
       THEN chr(CAST(97 + s_nationkey % 26 AS INT)) || 'e' END AS "RREL84",
  CASE WHEN s_suppkey % 12 IN (4, 5) THEN CASE WHEN s_suppkey % 2 = 0 THEN 'ND1'
       ELSE 'DE' || CAST(s_nationkey AS VARCHAR) END END AS "RREC6",
  CASE WHEN s_suppkey % 12 IN (6, 7) THEN CASE WHEN s_suppkey < 20 THEN 'ND2'
       ELSE 'IT' || CAST(s_nationkey AS VARCHAR) END END AS "RREL11",
  CASE WHEN s_suppkey % 12 = 8 THEN 'NL31' END AS "AR129",
  CASE WHEN s_suppkey % 12 = 9 THEN 'PT' END AS "NPEL20"
FROM supplier
"""


def template(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A template of field codes: repeated, missing and renewed ECB codes."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        key.alias("position"),
        F.concat(F.lit("RREL"), (key % 700).cast("string")).alias("esma_code"),
        F.concat(F.when(key % 7 == 3, "New ").otherwise(""), F.col("p_name")).alias("esma_name"),
        F.when(key % 11 != 0, F.concat(F.lit("AR"), (key % 400).cast("string"))).alias("ecb_code"),
    )


TEMPLATE = """
SELECT p_partkey AS position, 'RREL' || CAST(p_partkey % 700 AS VARCHAR) AS esma_code,
  CASE WHEN p_partkey % 7 = 3 THEN 'New ' ELSE '' END || p_name AS esma_name,
  CASE WHEN p_partkey % 11 <> 0 THEN 'AR' || CAST(p_partkey % 400 AS VARCHAR) END AS ecb_code
FROM part
"""

# The field-code pairs the documentation names.
DOCUMENTED_CODES = {"AR1": "RREL6", "AR2": "RREL3", "AR128": "RREC6"}


def ecb_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ECB rows under ECB codes."""
    return panel(spark, sf_dir).filter("source = 'ECB'").select(
        F.concat(F.lit("ECB"), text("pool_no")).alias("pool_id"),
        F.col("RREL6").alias("AR1"),
        F.col("RREL3").alias("AR2"),
        F.concat(F.lit("DE"), text("l_partkey")).alias("AR128"),
        F.col("RREC3"),
        F.col("l_linestatus").alias("AR7"),
    )


ECB_ROWS = f"""
SELECT 'ECB' || CAST(pool_no AS VARCHAR) AS pool_id, "RREL6" AS "AR1", "RREL3" AS "AR2",
  'DE' || CAST(l_partkey AS VARCHAR) AS "AR128", "RREC3", l_linestatus AS "AR7"
FROM ({PANEL}) WHERE source = 'ECB'
"""


def esma_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ESMA rows under ESMA codes."""
    return panel(spark, sf_dir).filter("source = 'ESMA'").select(
        F.concat(F.lit("ESMA"), text("pool_no")).alias("pool_id"),
        "RREL6",
        "RREL3",
        "RREC3",
        F.when(F.col("pool_no") % 2 == 0, "FR").alias("RREL81"),
        F.col("l_linestatus").alias("RREL4"),
    )


ESMA_ROWS = f"""
SELECT 'ESMA' || CAST(pool_no AS VARCHAR) AS pool_id, "RREL6", "RREL3", "RREC3",
  CASE WHEN pool_no % 2 = 0 THEN 'FR' END AS "RREL81", l_linestatus AS "RREL4"
FROM ({PANEL}) WHERE source = 'ESMA'
"""


def pool_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pool pairs: 7 has no ESMA file, 8 shares the ESMA pool of 0."""
    pool = F.col("s_suppkey") % 12
    return (
        table(spark, sf_dir, "supplier")
        .filter(pool.isin(0, 1, 2, 3, 7, 8))
        .select(
            F.concat(F.lit("ECB"), pool.cast("string")).alias("ecb_pool_id"),
            F.concat(
                F.lit("ESMA"), F.when(pool == 8, F.lit("0")).otherwise(pool.cast("string"))
            ).alias("esma_pool_id"),
        )
        .distinct()
    )


POOL_MAPPING = """
SELECT DISTINCT 'ECB' || CAST(s_suppkey % 12 AS VARCHAR) AS ecb_pool_id,
  'ESMA' || CASE WHEN s_suppkey % 12 = 8 THEN '0' ELSE CAST(s_suppkey % 12 AS VARCHAR) END
    AS esma_pool_id
FROM supplier WHERE s_suppkey % 12 IN (0, 1, 2, 3, 7, 8)
"""
