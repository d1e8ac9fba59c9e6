"""Pools: which source knows them, how large they are, where sources overlap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poolweave.functions.columns import cols
from poolweave.operators.mapping import ECB, ESMA
from poolweave.operators.skew import key_condition

MATCHED, ECB_ONLY, ESMA_ONLY = "matched", "ecb_only", "esma_only"
BUCKETS = (MATCHED, ECB_ONLY, ESMA_ONLY)

# Fixed value: compressed bytes above which a pool counts as large.
LARGE_POOL_BYTES = 100 * 1024 * 1024


def classify_pools(ecb_files: DataFrame, esma_files: DataFrame, mapping: DataFrame) -> DataFrame:
    """``ecb_pool_id, esma_pool_id, bucket`` for every pool.

    ``ecb_files`` and ``esma_files`` hold a ``pool_id`` per file; ``mapping`` holds
    ``ecb_pool_id, esma_pool_id``. A mapped pool is matched even if one side has no
    file, and an ESMA pool mapped twice appears twice.
    """
    nothing = F.lit(None).cast("string")
    matched = mapping.select("ecb_pool_id", "esma_pool_id", F.lit(MATCHED).alias("bucket"))
    ecb = ecb_files.select(F.col("pool_id").alias("ecb_pool_id")).distinct()
    esma = esma_files.select(F.col("pool_id").alias("esma_pool_id")).distinct()
    ecb_only = ecb.join(mapping.select("ecb_pool_id"), "ecb_pool_id", "left_anti").select(
        "ecb_pool_id", nothing.alias("esma_pool_id"), F.lit(ECB_ONLY).alias("bucket")
    )
    esma_only = esma.join(mapping.select("esma_pool_id"), "esma_pool_id", "left_anti").select(
        nothing.alias("ecb_pool_id"), "esma_pool_id", F.lit(ESMA_ONLY).alias("bucket")
    )
    return matched.unionByName(ecb_only).unionByName(esma_only)


def pool_sizes(
    files: DataFrame, pool: Sequence[str] = ("pool_id",), threshold: int = LARGE_POOL_BYTES
) -> DataFrame:
    """Files and bytes per pool, and whether the pool counts as large."""
    return (
        files.groupBy(*cols(pool))
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
        .withColumn("is_large", F.col("bytes") > threshold)
    )


def large_pools(
    pools: DataFrame, ecb_sizes: DataFrame, esma_sizes: DataFrame
) -> DataFrame:
    """Classified pools with ``is_large``: true if either side is large."""

    def side(sizes: DataFrame, prefix: str) -> DataFrame:
        return sizes.select(
            F.col("pool_id").alias(f"{prefix}_pool_id"), F.col("is_large").alias(f"__{prefix}")
        )

    either = F.coalesce("__ecb", F.lit(False)) | F.coalesce("__esma", F.lit(False))
    return (
        pools.join(side(ecb_sizes, "ecb"), "ecb_pool_id", "left")
        .join(side(esma_sizes, "esma"), "esma_pool_id", "left")
        .select("ecb_pool_id", "esma_pool_id", "bucket", either.alias("is_large"))
    )


def shared_periods(
    panel: DataFrame, pool: Sequence[str], period: str, source: str = "source"
) -> DataFrame:
    """(pool, period) combinations that both sources report."""
    both = F.bool_or(F.col(source) == ECB) & F.bool_or(F.col(source) == ESMA)
    return (
        panel.groupBy(*cols(pool), F.col(period))
        .agg(both.alias("__both"))
        .filter("__both")
        .drop("__both")
    )


def overlap_report(
    panel: DataFrame, pool: Sequence[str], month: str = "date_ym", source: str = "source"
) -> DataFrame:
    """Pools both sources report for the same month: months, first and last."""
    return (
        shared_periods(panel, pool, month, source)
        .groupBy(*cols(pool))
        .agg(
            F.count(F.lit(1)).alias("months"),
            F.min(month).alias("first_month"),
            F.max(month).alias("last_month"),
        )
    )


WORD_MONTHS = 64


def month_bits(
    panel: DataFrame, pool: Sequence[str], month: str = "date_ym", source: str = "source"
) -> DataFrame:
    """``pool…, word, ecb, esma``: the months each source reports, as bits.

    A word holds 64 months, so a row stands for five years of a pool. The state can be
    stored and merged with that of new rows (:func:`merged_bits`). Texts that are no
    month (``YYYY-MM``) are left out.
    """
    is_month = F.col(month).rlike(r"^\d{4}-(0[1-9]|1[0-2])$")
    number = F.substring(month, 1, 4).cast("int") * 12 + F.substring(month, 6, 2).cast("int") - 1
    placed = panel.filter(is_month).select(*cols(pool), F.col(source).alias("__source"), number.alias("__month"))
    word = F.floor(F.col("__month") / WORD_MONTHS).cast("int").alias("word")
    # A shift by a column: one long with the month's bit.
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("__month") % WORD_MONTHS)
    return placed.groupBy(*cols(pool), word).agg(
        *(
            F.coalesce(F.bit_or(F.when(F.col("__source") == s, bit)), F.lit(0).cast("long")).alias(name)
            for s, name in ((ECB, "ecb"), (ESMA, "esma"))
        )
    )


def merged_bits(states: DataFrame, pool: Sequence[str]) -> DataFrame:
    """Several states, united by rows, as one."""
    return states.groupBy(*cols(pool), "word").agg(F.bit_or("ecb").alias("ecb"), F.bit_or("esma").alias("esma"))


def overlap_of_bits(bits: DataFrame, pool: Sequence[str]) -> DataFrame:
    """As :func:`overlap_report`, from bits alone: a month of both sources is set in both."""
    both = F.col("ecb").bitwiseAND(F.col("esma"))
    words = bits.withColumn("__both", both).filter("__both <> 0")
    lowest = F.bit_count(F.col("__both").bitwiseAND(-F.col("__both")) - 1)
    lowest = F.when(F.col("__both") == F.lit(-(2**63)), 63).otherwise(lowest)
    highest = F.length(F.bin("__both")) - 1

    def text(number: Column) -> Column:
        year, month = F.floor(number / 12).cast("string"), (number % 12 + 1).cast("string")
        return F.concat(F.lpad(year, 4, "0"), F.lit("-"), F.lpad(month, 2, "0"))

    at = F.col("word") * WORD_MONTHS
    return words.groupBy(*cols(pool)).agg(
        F.sum(F.bit_count("__both")).cast("long").alias("months"),
        text(F.min(at + lowest)).alias("first_month"),
        text(F.max(at + highest)).alias("last_month"),
    )


def pending(items: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Items of a manifest that are not in the manifest of finished ones."""
    finished = done.select(*cols(keys)).distinct()
    finished = finished.withColumnsRenamed({k: "__done_" + k for k in keys})
    same = key_condition(cols(keys), cols("__done_" + k for k in keys))
    return items.join(finished, same, "left_anti")
