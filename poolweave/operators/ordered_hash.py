"""Checksums of rows in their order, computed per sorted range and combined.

A group's checksum is the sum of each row's digest times a power of a base whose
exponent is the row's place, modulo a prime; two bases give 62 bits. A range has a value
and a length, and two neighbours make one: the second value is multiplied by the base to
the power of the first one's length. This is associative, so ranges may be cut anywhere,
and equal rows in another order give another checksum. No rows are collected and none
are numbered through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from poolweave.functions.columns import cols
from poolweave.operators.quality import row_text

PRIME = (1 << 31) - 1
BASES = (48271, 69621)
_DIGIT, _DIGITS = 8, 5  # a place below 2**40 is five digits to the base 2**8
_TASK, _PLACE = "__task", "__place"


def power(base: int, exponent: Column) -> Column:
    """``base`` to the power of a number from 0 to below 2**40, modulo the prime."""
    result = None
    for d in range(_DIGITS):
        step = pow(base, 1 << d * _DIGIT, PRIME)
        table = F.array(*(F.lit(pow(step, k, PRIME)).cast("long") for k in range(1 << _DIGIT)))
        digit = F.shiftright(exponent, d * _DIGIT).bitwiseAND(F.lit((1 << _DIGIT) - 1)).cast("int")
        factor = F.get(table, digit)
        result = factor if result is None else result * factor % PRIME
    return result


def _digests(columns: Sequence[str]) -> list[Column]:
    """Two 28-bit numbers of a row's MD5."""
    md5 = F.md5(row_text(columns))
    return [F.conv(F.substring(md5, 1 + 7 * k, 7), 16, 10).cast("long") for k in range(len(BASES))]


def range_hashes(ordered: DataFrame, group: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """``group…, task, rows, values`` of each task's share of each group.

    ``ordered`` is laid out as :func:`poolweave.operators.ordering.sort_panel` does it:
    tasks follow each other, and a task's rows too.
    """
    columns = sorted(c for c in (columns or ordered.columns) if c not in group)
    placed = ordered.select(
        *cols(group),
        *(d.alias(f"__digest_{k}") for k, d in enumerate(_digests(columns))),
        F.spark_partition_id().alias(_TASK),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias(_PLACE),
    )
    weighted = [F.col(f"__digest_{k}") * power(b, F.col(_PLACE)) % PRIME for k, b in enumerate(BASES)]
    sums = placed.groupBy(*cols(group), _TASK).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(_PLACE).alias("__first"),
        *((F.sum(w) % PRIME).alias(f"__sum_{k}") for k, w in enumerate(weighted)),
    )
    # Places count from the task's start: the power of the group's first one is taken out.
    back = F.lit(PRIME - 1) - F.col("__first") % (PRIME - 1)
    own = [F.col(f"__sum_{k}") * power(b, back) % PRIME for k, b in enumerate(BASES)]
    return sums.select(*cols(group), F.col(_TASK).alias("task"), "rows", F.array(*own).alias("values"))


def combined(ranges: DataFrame, group: Sequence[str], order: str = "task") -> DataFrame:
    """``group…, rows, ordered_checksum`` of ranges that follow each other by ``order``.

    One row per range moves. Stored ranges of a growing table can be combined with new
    ones behind them.
    """
    before = Window.partitionBy(*cols(group)).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    shifted = ranges.withColumn("__before", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    parts = [F.get("values", F.lit(k)) * power(b, F.col("__before")) % PRIME for k, b in enumerate(BASES)]
    sums = shifted.groupBy(*cols(group)).agg(
        F.sum("rows").alias("rows"), *((F.sum(p) % PRIME).alias(f"__value_{k}") for k, p in enumerate(parts))
    )
    checksum = F.col("__value_0") * (1 << 31) + F.col("__value_1")
    return sums.select(*cols(group), "rows", checksum.alias("ordered_checksum"))


def ordered_checksum(ordered: DataFrame, group: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Checksum of each group's rows in their order; up to 2**40 rows of a group."""
    return combined(range_hashes(ordered, group, columns), group)
