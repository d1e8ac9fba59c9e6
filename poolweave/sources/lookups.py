"""Small configuration tables: the field-code template and the pool mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poolweave.functions.columns import col

# Column titles of the template sheet.
TEMPLATE_ESMA_CODE = "FIELD CODE"
TEMPLATE_ESMA_NAME = "FIELD NAME"
TEMPLATE_ECB_CODE = "For info: existing ECB or EBA NPL template field code"


def read_template(spark: SparkSession, path: str) -> DataFrame:
    """``position, esma_code, esma_name, ecb_code`` from the template saved as CSV.

    Row order decides between several codes; the file is one small sheet and is read
    in one task, where ids rise in row order.
    """
    sheet = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", True)
        .csv(path)
    )
    return template_table(
        sheet.withColumn("position", F.monotonically_increasing_id()), "position"
    )


def template_table(sheet: DataFrame, position: str) -> DataFrame:
    return sheet.select(
        col(position).alias("position"),
        col(TEMPLATE_ESMA_CODE).alias("esma_code"),
        col(TEMPLATE_ESMA_NAME).alias("esma_name"),
        col(TEMPLATE_ECB_CODE).alias("ecb_code"),
    )


def read_pool_mapping(spark: SparkSession, path: str) -> DataFrame:
    """``ecb_pool_id, esma_pool_id`` from ``{"pools": {ecb: {"esma_pool": esma}}}``."""
    document = (
        spark.read.schema("pools map<string,struct<esma_pool:string>>")
        .option("multiLine", True)
        .json(path)
    )
    return document.select(F.explode("pools").alias("ecb_pool_id", "pool")).select(
        "ecb_pool_id", F.col("pool.esma_pool").alias("esma_pool_id")
    )
