"""Sorted panels: order by key inside a group, without one task per group."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from poolweave.functions.columns import SORT_KEYS, col, cols
from poolweave.operators.skew import lookup_join
from poolweave.session import materialize

_TASK, _ROW = "__task", "__row"
TIE_FAN_OUT = 256
RANGE_VALUES = 4_000_000  # rows times columns of a range, sorted in memory: some 150 MB


def available_keys(columns: Sequence[str], keys: Sequence[str] = SORT_KEYS) -> list[str]:
    """Sort keys the table has; a missing one is a warning, all missing an error."""
    available = [k for k in keys if k in columns]
    for k in keys:
        if k not in available:
            warnings.warn(f"sort column {k} not found, skipping", stacklevel=3)
    if not available:
        raise ValueError("No sort columns found")
    return available


def sort_order(
    columns: Sequence[str],
    keys: Sequence[str],
    group: Sequence[str] = (),
    break_ties: bool = False,
) -> list[Column]:
    """Group, then keys, nulls last, then the remaining columns if ties matter."""
    names = [*group, *keys]
    if break_ties:
        names += sorted(set(columns) - set(names))
    return [col(n).asc_nulls_last() for n in names]


def sort_panel(
    df: DataFrame,
    keys: Sequence[str] = SORT_KEYS,
    group: Sequence[str] = (),
    *,
    break_ties: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Range-partitioned and sorted rows of all groups.

    A large group spreads over many tasks, since the ranges are cut inside it; equal
    keys are cut too, by a salt of the reading task that only the ranges see. Without
    ``partitions`` the rows are counted, and ranges become more and not larger with them.
    """
    keys = available_keys(df.columns, keys)
    order = sort_order(df.columns, keys, group, break_ties)
    salt = F.pmod(F.spark_partition_id(), F.lit(TIE_FAN_OUT)).alias("__salt")
    salted = df.select("*", salt)
    ranges = [*order, F.col("__salt")]
    if partitions is None:
        partitions = df.count() * len(df.columns) // RANGE_VALUES + 1
    spread = salted.repartitionByRange(partitions, *ranges)
    return spread.sortWithinPartitions(*ranges).drop("__salt")


def with_position(
    df: DataFrame,
    keys: Sequence[str] = SORT_KEYS,
    group: Sequence[str] = (),
    *,
    break_ties: bool = True,
    partitions: int | None = None,
    position: str = "position",
) -> DataFrame:
    """Number the rows of each group from 1 in sort order.

    Each task numbers its own sorted range; the ranges before it in the group are
    added from one count per (group, task). The sorted rows are written once, so
    that counts and rows come from the same ranges.
    """
    ordered = sort_panel(df, keys, group, break_ties=break_ties, partitions=partitions)
    numbered = materialize(
        ordered.withColumns(
            {
                _TASK: F.spark_partition_id(),
                _ROW: F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
            }
        ),
        "sorted",
    )
    ranges = numbered.groupBy(*cols(group), _TASK).agg(
        F.count(F.lit(1)).alias("__rows"), F.min(_ROW).alias("__first")
    )
    earlier = Window.partitionBy(*cols(group)).orderBy(_TASK).rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = ranges.select(
        *cols(group),
        _TASK,
        (F.coalesce(F.sum("__rows").over(earlier), F.lit(0)) - F.col("__first") + 1).alias(
            "__shift"
        ),
    )
    # One row per group and task, so the lookup grows with the tasks, not the rows.
    return lookup_join(numbered, offsets, [*group, _TASK], "inner").select(
        *cols(df.columns), (F.col(_ROW) + F.col("__shift")).alias(position)
    )
