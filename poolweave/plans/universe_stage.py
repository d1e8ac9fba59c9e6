"""Stage 2: both sources under one set of codes, per pool, without covered rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poolweave.functions.names import ecb_pool_id, esma_pool_id, safe_pool_id
from poolweave.operators.columns import union_aligned
from poolweave.operators.mapping import mark_ecb, mark_esma, prepare_ecb, prepare_esma
from poolweave.operators.pools import classify_pools, overlap_report, pending
from poolweave.operators.prefer import prefer_source
from poolweave.operators.quality import row_hash
from poolweave.operators.skew import lookup_join
from poolweave.session import materialize
from poolweave.sources.manifest import (
    base_path,
    ecb_files,
    merged_esma_files,
    parse_header,
)
from poolweave.sources.salvage import probe_gzip, salvage
from poolweave.sources.one_scan import Place, scan_once
from poolweave.sources.scan import scan_manifest

# Pools known to be reported by both sources for the same months.
KNOWN_OVERLAP_POOLS = (
    "RMBMBE000095100120084",
    "RMBMFR000083100220149",
    "RMBMNL000185100120109",
)
ALL_POOLS, DERIVED = "all", "auto"
POOL = ("pool_id", "bucket")


@dataclass
class EcbRows:
    """ECB rows, and the quarantine table of damaged files with the reason."""

    rows: DataFrame
    quarantined: DataFrame


def read_ecb(spark: SparkSession, folder: str, ecb_to_esma: Mapping[str, str]) -> EcbRows:
    """All ECB files of a folder, harmonised.

    Each file is read once as a stream for its header and for damage. Sound files are
    read in one scan; what is left of damaged ones is added with ``salvaged = true``.
    The result is landed, so that later passes read columns instead of text.
    """
    files = materialize(ecb_files(spark, folder), "ecb-files")
    checked = materialize(_checked(files, folder), "ecb-checked")

    def prepared(df: DataFrame) -> DataFrame:
        return prepare_ecb(df, ecb_to_esma)

    parts = []
    sound = checked.filter(F.col("error").isNull() & F.col("header_line").isNotNull())
    if not sound.isEmpty():
        # The scan would stop at a damaged file of the folder; then sound ones are listed.
        place = Place(folder, "*.gz")
        if not checked.filter(F.col("error").isNotNull()).isEmpty():
            place = Place([row.path for row in sound.select("path").collect()])
        scanned = scan_once(place, sound, renames=ecb_to_esma, derive=mark_ecb)
        parts.append(scanned.withColumn("salvaged", F.lit(False)))
    damaged = (
        checked.filter(F.col("error").isNotNull() & F.col("header_line").isNotNull())
        .groupBy("header_line")
        .agg(F.collect_list("path").alias("paths"))
        .collect()
    )
    for group in damaged:
        rows = salvage(spark, group["paths"], parse_header(group["header_line"]))
        parts.append(prepared(rows))
    if not parts:
        raise ValueError(f"no readable ECB file in {folder}")
    rows = union_aligned(parts, sort_columns=False).withColumn(
        "pool_id", ecb_pool_id(F.col("file_name"))
    )
    quarantined = checked.filter(F.col("error").isNotNull()).select("path", "pool_id", "error")
    return EcbRows(materialize(rows, "ecb-landed"), quarantined)


def _checked(files: DataFrame, folder: str) -> DataFrame:
    """Files with ``header_line`` and ``error``, whatever their size."""
    if files.isEmpty():
        raise ValueError("no ECB file found")
    probed = probe_gzip(files.sparkSession, folder, "*.gz").withColumn("__file", base_path(F.col("path")))
    keyed = files.withColumn("__file", base_path(F.col("path")))
    return keyed.join(probed.drop("path"), "__file").drop("__file")


def read_esma(spark: SparkSession, folder: str) -> DataFrame:
    """All merged ESMA files of a folder, as stage 1 exports them."""
    files = merged_esma_files(spark, folder)
    rows = scan_manifest(files, Place(folder, "*.csv"), derive=mark_esma)
    return materialize(
        rows.withColumn("pool_id", esma_pool_id(F.col("file_name"))), "esma-landed"
    )


def esma_from_pairs(joined: DataFrame) -> DataFrame:
    """Stage 1 rows as stage 2 input, without writing CSV in between."""
    renamed = joined.drop("asset_type", "identifier", "date", "ue_name")
    return prepare_esma(renamed.withColumnRenamed("merged_name", "file_name"))


def universe(
    ecb: DataFrame,
    esma: DataFrame,
    mapping: DataFrame,
    *,
    overlap_pools: Sequence[str] | str = KNOWN_OVERLAP_POOLS,
    finished: DataFrame | None = None,
) -> DataFrame:
    """All pools of both sources in one table.

    ``ecb`` and ``esma`` are prepared rows with ``pool_id``; ``mapping`` pairs the
    ids. The result has ``bucket``, ``pool_id`` (the ECB id where there is one),
    ``ecb_pool_id``, ``esma_pool_id`` and ``source``. ECB rows that ESMA covers are
    dropped in ``overlap_pools``: ids, ``"all"``, or ``"auto"`` for the pools where
    both sources report a month. Pools in ``finished`` (``pool_id, bucket``) are left
    out.
    """
    pools = classify_pools(ecb.select("pool_id"), esma.select("pool_id"), mapping)
    if finished is not None:
        written_id = safe_pool_id(F.coalesce("ecb_pool_id", "esma_pool_id"))
        pools = pending(pools.withColumn("pool_id", written_id), finished, POOL).drop("pool_id")
    pools = materialize(pools, "pools")
    ecb_rows = _with_pool(ecb, pools, "ecb_pool_id")
    esma_rows = _with_pool(esma, pools, "esma_pool_id")
    panel = union_aligned([ecb_rows, esma_rows], sort_columns=False)

    if isinstance(overlap_pools, str):
        chosen = {
            ALL_POOLS: lambda: None,
            DERIVED: lambda: materialize(overlap_report(panel, POOL).select(*POOL), "overlap"),
        }[overlap_pools]()
    else:
        chosen = list(overlap_pools)
        if not chosen:
            return panel.drop("date_ym")
    return prefer_source(panel, POOL, overlap_pools=chosen).drop("date_ym")


def pool_signatures(ecb: DataFrame, esma: DataFrame, mapping: DataFrame) -> DataFrame:
    """``pool_id`` (as written), ``bucket`` and a ``signature`` of the rows each pool is made of.

    The signature adds up row hashes, so it changes with every file that arrives, goes or
    is replaced, and not with the order of files.
    """

    def summed(rows: DataFrame, own_id: str) -> DataFrame:
        fields = sorted(c for c in rows.columns if c not in ("pool_id", "block_start", "row_place"))
        total = F.sum(row_hash(fields).cast("decimal(38,0)")).cast("string")
        return rows.groupBy(F.col("pool_id").alias(own_id)).agg(F.concat_ws("x", F.count(F.lit(1)), total).alias(f"__{own_id}"))

    pools = classify_pools(ecb.select("pool_id"), esma.select("pool_id"), mapping)
    written = safe_pool_id(F.coalesce("ecb_pool_id", "esma_pool_id")).alias("pool_id")
    parts = [F.coalesce(f"__{own_id}", F.lit("-")) for own_id in ("ecb_pool_id", "esma_pool_id")]
    joined = pools.join(summed(ecb, "ecb_pool_id"), "ecb_pool_id", "left").join(
        summed(esma, "esma_pool_id"), "esma_pool_id", "left"
    )
    # A pool mapped twice is written once, with the rows of both.
    return joined.select(written, "bucket", F.concat_ws("/", *parts).alias("__part")).groupBy("pool_id", "bucket").agg(
        F.array_join(F.array_sort(F.collect_list("__part")), "+").alias("signature")
    )


def _with_pool(rows: DataFrame, pools: DataFrame, own_id: str) -> DataFrame:
    """Attach the pool's ids and bucket; a pool mapped twice repeats its rows."""
    known = pools.filter(F.col(own_id).isNotNull())
    joined = lookup_join(
        rows.withColumnRenamed("pool_id", own_id), known, [own_id], "inner", null_safe=False
    )
    return joined.withColumn("pool_id", F.coalesce("ecb_pool_id", "esma_pool_id"))
