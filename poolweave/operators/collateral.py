"""Loans joined to their collateral, file pairs, and statistics about both."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from poolweave.functions.columns import (
    col,
    collateral_columns_to_drop,
    cols,
    detect_join_key,
    join_key_error,
    overlap_renames,
)
from poolweave.operators.skew import (
    FAN_OUT,
    HOT_ROWS,
    balanced_left_join,
    key_condition,
)

MATCHED_MARKER = "has_collateral"


def join_collateral(
    loans: DataFrame,
    collateral: DataFrame,
    pair: Sequence[str] = (),
    *,
    keys: tuple[str, str] | None = None,
    match_null_keys: bool = False,
    marker: str | None = None,
    hot_rows: int = HOT_ROWS,
    fan_out: int = FAN_OUT,
) -> DataFrame:
    """Every loan row with each of its collateral rows, or with nulls.

    Both tables may hold many file pairs: the ``pair`` columns are then part of the
    key. The join key is found in the headers unless given. Repeated metadata of the
    collateral is dropped, other clashing columns get a suffix. ``marker`` names an
    extra column that is true where collateral was found. A missing key matches
    nothing, unless ``match_null_keys`` lets every row without a key meet every other:
    ask :func:`join_statistics` first how many rows that gives.
    """
    keys = keys or detect_join_key(loans.columns, collateral.columns)
    if keys is None:
        raise ValueError(join_key_error(loans.columns, collateral.columns))
    loan_key, collateral_key = keys

    right = collateral.drop(*collateral_columns_to_drop(collateral.columns))
    pair_right = {p: "__pair_" + p for p in pair}
    own = [c for c in right.columns if c not in pair_right]
    renames = overlap_renames([c for c in loans.columns if c not in pair_right], own)
    right = right.withColumnsRenamed({**renames, **pair_right})
    collateral_key = renames.get(collateral_key, collateral_key)

    found = marker or MATCHED_MARKER
    joined = balanced_left_join(
        loans,
        right,
        [*pair_right.items(), (loan_key, collateral_key)],
        marker=found,
        null_safe=match_null_keys,
        hot_rows=hot_rows,
        fan_out=fan_out,
    ).drop(*pair_right.values())
    return joined if marker else joined.drop(found)


def join_statistics(
    loans: DataFrame,
    collateral: DataFrame,
    pair: Sequence[str],
    keys: tuple[str, str],
    *,
    match_null_keys: bool = False,
) -> DataFrame:
    """Row counts of the join per pair, from rows per key; the join is not run."""
    loan_key, collateral_key = keys
    pair_right = {p: "__pair_" + p for p in pair}
    left = loans.groupBy(*cols([*pair, loan_key])).agg(F.count(F.lit(1)).alias("l"))
    right = (
        collateral.groupBy(*cols([*pair, collateral_key]))
        .agg(F.count(F.lit(1)).alias("r"))
        .withColumnsRenamed({**pair_right, collateral_key: "__key"})
    )
    same = key_condition(
        cols([*pair, loan_key]), cols([*pair_right.values(), "__key"]), match_null_keys
    )
    pair_keys = [F.coalesce(col(p), col(q)).alias(p) for p, q in pair_right.items()]
    l, r = F.coalesce("l", F.lit(0)), F.coalesce("r", F.lit(0))
    return (
        left.join(right, same, "full")
        .groupBy(*pair_keys)
        .agg(
            F.sum(l).alias("ue_rows"),
            F.sum(r).alias("collateral_rows"),
            F.sum(l * F.greatest(r, F.lit(1))).alias("merged_rows"),
            F.sum(l * r).alias("matched_rows"),
            F.sum(F.when(r == 0, l).otherwise(0)).alias("unmatched_rows"),
        )
        .withColumn("merge_keys", F.lit(f"{loan_key}={collateral_key}"))
    )


def pair_files(files: DataFrame) -> DataFrame:
    """Loan files with the collateral file of the same asset type, pool and date.

    ``files`` has ``name`` and the parsed name fields. With several collateral files for a key the highest
    sequence counts, then the last name.
    """
    key = ["asset_type", "identifier", "date"]
    # One pass over the names: a join would take each of them apart again on both sides,
    # and for every key once more in the filters for missing ones. Names of another form
    # stay apart by themselves.
    same = Window.partitionBy(*key, F.when(F.col("category").isNull(), F.col("name")))
    recency = F.struct(F.col("sequence").cast("decimal(38,0)").alias("sequence"), F.col("name").alias("name"))
    latest = F.max(F.when(F.col("category") == "Collateral", recency)).over(same)
    return (
        files.select(*key, "category", "name", "sequence")
        .withColumn("__latest", latest)
        .filter((F.col("category") == "UE") & F.col("__latest").isNotNull())
        .select(*key, F.col("name").alias("ue_name"), F.col("__latest.name").alias("collateral_name"))
    )


def success_by_type(statistics: DataFrame) -> DataFrame:
    return statistics.groupBy("asset_type").agg(F.count(F.lit(1)).alias("pairs"))


def keys_used(statistics: DataFrame) -> DataFrame:
    return statistics.groupBy("merge_keys").agg(F.count(F.lit(1)).alias("pairs"))


def error_summary(failed: DataFrame) -> DataFrame:
    """Failed pairs by their error text."""
    return failed.groupBy("error").agg(F.count(F.lit(1)).alias("pairs"))


def batch_summary(statistics: DataFrame, failed: DataFrame) -> DataFrame:
    """Joined and failed pairs of a batch, one row."""
    both = statistics.select(F.lit(True).alias("joined")).unionAll(failed.select(F.lit(False)))
    return both.agg(
        F.count_if("joined").alias("joined_pairs"), F.count_if(~F.col("joined")).alias("failed_pairs")
    )


def row_totals(statistics: DataFrame) -> DataFrame:
    return statistics.agg(
        F.sum("ue_rows").alias("total_ue_rows_processed"),
        F.sum("merged_rows").alias("total_merged_rows"),
        F.sum("matched_rows").alias("rows_with_collateral_match"),
    )
