"""From the template of field codes to renamed, marked loan tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poolweave.functions.columns import col
from poolweave.functions.names import month

ECB, ESMA = "ECB", "ESMA"

# Field codes with a role in the pipeline.
DATE_CODE = "RREL6"
LOAN_CODE = "RREL3"
ECB_DATE_CODE = "AR1"
NEWER_FIELD_WORD = "New"


def forward_mapping(template: DataFrame) -> DataFrame:
    """One ESMA code per ECB code.

    ``template`` has ``position, esma_code, esma_name, ecb_code``. The first row
    of an ECB code counts, unless rows name a newer field: then the last of those.
    """
    newer = F.col("esma_name").contains(NEWER_FIELD_WORD)
    first = F.min_by("esma_code", "position")
    last_newer = F.max_by(F.when(newer, F.col("esma_code")), F.when(newer, F.col("position")))
    return (
        template.filter(F.col("ecb_code").isNotNull())
        .groupBy("ecb_code")
        .agg(F.coalesce(last_newer, first).alias("esma_code"))
    )


def reverse_mapping(template: DataFrame) -> DataFrame:
    """One ECB code per ESMA code: the last row counts."""
    return (
        template.filter(F.col("ecb_code").isNotNull())
        .groupBy("esma_code")
        .agg(F.max_by("ecb_code", "position").alias("ecb_code"))
    )


def as_dict(mapping: DataFrame) -> dict[str, str]:
    """The forward mapping on the driver: one entry per field code of the template."""
    return {row.ecb_code: row.esma_code for row in mapping.collect()}


def rename_codes(df: DataFrame, ecb_to_esma: Mapping[str, str]) -> DataFrame:
    """Rename the mapped columns that are present; refuse to make two alike."""
    renames = {c: ecb_to_esma[c] for c in df.columns if c in ecb_to_esma}
    result = [renames.get(c, c) for c in df.columns]
    clashes = sorted({c for c in result if result.count(c) > 1})
    if clashes:
        origins = {t: [c for c in df.columns if renames.get(c, c) == t] for t in clashes}
        raise ValueError(f"several columns would get one field code: {origins}")
    return df.select(*(col(a).alias(b) for a, b in zip(df.columns, result)))


def month_key(columns: Sequence[str], *candidates: str) -> Column:
    """Month of the first date column the table has; empty text without one."""
    for name in candidates:
        if name in columns:
            return month(col(name))
    return F.lit("")


def prepare_ecb(df: DataFrame, ecb_to_esma: Mapping[str, str]) -> DataFrame:
    """ECB rows under ESMA codes, with ``source`` and ``date_ym``."""
    renamed = rename_codes(df, ecb_to_esma)
    return renamed.withColumns(
        {
            "source": F.lit(ECB),
            "date_ym": month_key(renamed.columns, DATE_CODE, ECB_DATE_CODE),
        }
    )


def prepare_esma(df: DataFrame) -> DataFrame:
    """ESMA rows with ``source`` and ``date_ym``."""
    return df.withColumns(
        {"source": F.lit(ESMA), "date_ym": month_key(df.columns, DATE_CODE)}
    )


def month_of_row(df: DataFrame, has: Callable[[str], Column], *candidates: str) -> Column:
    """As :func:`month_key` where rows come from several headers: ``has`` tells a row's columns."""
    found = F.lit("")
    for name in reversed([c for c in candidates if c in df.columns]):
        found = F.when(has(name), month(col(name))).otherwise(found)
    return found


def mark_ecb(df: DataFrame, has: Callable[[str], Column]) -> DataFrame:
    """``source`` and ``date_ym`` of renamed ECB rows of several headers."""
    date = month_of_row(df, has, DATE_CODE, ECB_DATE_CODE)
    return df.withColumns({"source": F.lit(ECB), "date_ym": date})


def mark_esma(df: DataFrame, has: Callable[[str], Column]) -> DataFrame:
    """``source`` and ``date_ym`` of ESMA rows of several headers."""
    return df.withColumns({"source": F.lit(ESMA), "date_ym": month_of_row(df, has, DATE_CODE)})
