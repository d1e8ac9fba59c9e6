"""Drop rows of one source that the preferred source covers for the same month.

The wide rows are not shuffled to find these. The keys in question are found on the key
columns alone (both sides reduced to distinct keys before they meet, so a hot key is
one row by then); the wide table then meets that key set in one anti join, whose way is
chosen at run time by the set's size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolweave.functions.columns import cols
from poolweave.operators.mapping import ECB, ESMA, LOAN_CODE
from poolweave.operators.skew import key_condition


def covered_keys(
    panel: DataFrame,
    pool: Sequence[str],
    loan: str = LOAN_CODE,
    month: str = "date_ym",
    source: str = "source",
    *,
    secondary: str = ECB,
    preferred: str = ESMA,
) -> DataFrame:
    """Keys of secondary rows that the preferred source also reports, with counts.

    A null loan or month equals a null one.
    """
    keys = [*pool, loan, month]
    is_preferred = F.col(source) == preferred
    counted = (
        panel.filter(F.col(source).isin(secondary, preferred))
        .groupBy(*cols(keys))
        .agg(
            F.count_if(~is_preferred).alias("covered_rows"),
            F.count_if(is_preferred).alias("covering_rows"),
        )
    )
    return counted.filter((F.col("covered_rows") > 0) & (F.col("covering_rows") > 0))


def prefer_source(
    panel: DataFrame,
    pool: Sequence[str] = ("pool_id",),
    loan: str = LOAN_CODE,
    month: str = "date_ym",
    source: str = "source",
    *,
    overlap_pools: DataFrame | Sequence | None = None,
    secondary: str = ECB,
    preferred: str = ESMA,
) -> DataFrame:
    """All preferred rows, and the secondary rows they do not cover.

    ``overlap_pools`` restricts the check to some pools: a list of ids of the first
    pool column, a DataFrame of pool columns, or ``None`` for every pool. Rows of
    other pools, and copies within one source, are never touched. A table without
    the loan column passes through.
    """
    if loan not in panel.columns:
        return panel
    keys = [*pool, loan, month]
    candidates = restrict_pools(panel.select(*cols([*keys, source])), pool, overlap_pools)
    covered = covered_keys(
        candidates, pool, loan, month, source, secondary=secondary, preferred=preferred
    )
    doomed = covered.select(*(F.col(k).alias("__covered_" + k) for k in keys))
    # One row per covered key: small sets are broadcast at run time; otherwise the
    # wide side's large partitions can be split, as an anti join keeps its left rows.
    same = key_condition(cols(keys), cols(doomed.columns)) & (F.col(source) == secondary)
    return panel.join(doomed, same, "left_anti")


def restrict_pools(
    df: DataFrame, pool: Sequence[str], pools: DataFrame | Sequence | None
) -> DataFrame:
    """Rows of the given pools; a list becomes a filter that can reach the scan."""
    if pools is None:
        return df
    if isinstance(pools, DataFrame):
        chosen = pools.select(*(F.col(p).alias("__chosen_" + p) for p in pool)).distinct()
        return df.join(chosen, key_condition(cols(pool), cols(chosen.columns)), "left_semi")
    return df.filter(F.col(pool[0]).isin(list(pools)))


def removal_report(
    panel: DataFrame,
    pool: Sequence[str] = ("pool_id",),
    loan: str = LOAN_CODE,
    month: str = "date_ym",
    source: str = "source",
    *,
    overlap_pools: DataFrame | Sequence | None = None,
    secondary: str = ECB,
    preferred: str = ESMA,
) -> DataFrame:
    """Rows per pool before and after :func:`prefer_source`, from key counts alone."""
    keys = [*pool, loan, month]
    counts = panel.groupBy(*cols(pool)).agg(F.count(F.lit(1)).alias("rows_before"))
    candidates = restrict_pools(panel.select(*cols([*keys, source])), pool, overlap_pools)
    removed = (
        covered_keys(
            candidates, pool, loan, month, source, secondary=secondary, preferred=preferred
        )
        .groupBy(*cols(pool))
        .agg(F.sum("covered_rows").alias("rows_removed"))
        .withColumnsRenamed({p: "__" + p for p in pool})
    )
    same_pool = key_condition(cols(pool), cols("__" + p for p in pool))
    return counts.join(removed, same_pool, "left").select(
        *cols(pool),
        "rows_before",
        (F.col("rows_before") - F.coalesce("rows_removed", F.lit(0))).alias("rows_after"),
        F.coalesce("rows_removed", F.lit(0)).alias("rows_removed"),
    )
