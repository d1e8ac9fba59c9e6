"""Differences of two tables from sketches, so that equal rows never move.

Every row adds to three cells of a sketch of its part, or takes away from them on the
other side: a count, the sum of its hash and the sum of a hash of that. Equal rows
cancel; what is left of a part is peeled: a cell that one hash alone fills names it and
its number, and is taken out of its other cells. A sketch has a fixed number of cells,
so what moves grows with the differences and not with the tables. Only rows of the named
hashes are compared then. A part with more differences than its sketch can hold is
compared row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poolweave.functions.columns import cols
from poolweave.operators.quality import row_differences, row_hash
from poolweave.operators.skew import lookup_join
from poolweave.session import materialize

PARTS, CELLS = 256, 1024
#: Hashes are numbers below this prime, so that sums can be divided by counts.
PRIME = (1 << 61) - 1
_HALF = 31
_FACTORS = ((40503, 31153), (34283, 60493), (50111, 27361))  # odd, of 16 bits
_SIGN, _PART, _HASH = "__sign", "__part", "__hash"


def _row_number(columns: Sequence[str]) -> Column:
    return F.pmod(row_hash(columns), F.lit(PRIME))


def _check(number: int) -> int:
    """A hash of a hash; squares and a shift are plain in SQL and in Python."""
    low = number & ((1 << _HALF) - 1)
    high = number >> _HALF
    return (low * 1_000_003 + high * 7_368_787 + (low * high & ((1 << 61) - 1))) % PRIME


def _check_column(number: Column) -> Column:
    low = number.bitwiseAND(F.lit((1 << _HALF) - 1))
    high = F.shiftright(number, _HALF)
    return (low * 1_000_003 + high * 7_368_787 + (low * high).bitwiseAND(F.lit((1 << 61) - 1))) % PRIME


def _cells(number: Column, cells: int) -> Column:
    """Three cells, one in each third of the sketch."""
    third = cells // 3
    low, high = number.bitwiseAND(F.lit((1 << _HALF) - 1)), F.shiftright(number, _HALF)
    return F.array(
        *(F.shiftright(low * a + high * b, 7) % third + k * third for k, (a, b) in enumerate(_FACTORS))
    )


def _cells_of(number: int, cells: int) -> list[int]:
    third = cells // 3
    low, high = number & ((1 << _HALF) - 1), number >> _HALF
    return [((low * a + high * b) >> 7) % third + k * third for k, (a, b) in enumerate(_FACTORS)]


def difference_sketch(before: DataFrame, after: DataFrame, parts: int = PARTS, cells: int = CELLS) -> DataFrame:
    """``part, cell, count`` and sums of the cells in which the two sides differ."""
    columns = sorted(before.columns)
    number = _row_number(columns)

    def signed(df: DataFrame, sign: int) -> DataFrame:
        return df.select(number.alias(_HASH), F.lit(sign).cast("long").alias(_SIGN))

    both = signed(before, 1).unionAll(signed(after, -1)).withColumns(
        {"__check": _check_column(F.col(_HASH)), _PART: F.pmod(_HASH, F.lit(parts)).cast("int")}
    )
    spread = both.withColumn("cell", F.explode(_cells(F.col(_HASH), cells).cast("array<int>")))
    # Halves of the numbers: their sums stay within 64 bits for 2**32 rows of a cell.
    halves = {
        f"{name}_{side}": F.sum(F.col(_SIGN) * half)
        for name in (_HASH, "__check")
        for side, half in (
            ("low", F.col(name).bitwiseAND(F.lit((1 << _HALF) - 1))),
            ("high", F.shiftright(F.col(name), _HALF)),
        )
    }
    summed = spread.groupBy(F.col(_PART).alias("part"), "cell").agg(
        F.sum(_SIGN).alias("count"), *(c.alias(n.strip("_")) for n, c in halves.items())
    )
    filled = [F.col(c) != 0 for c in ("count", "hash_low", "hash_high", "check_low", "check_high")]
    return summed.filter(filled[0] | filled[1] | filled[2] | filled[3] | filled[4])


def peeled(sketch: DataFrame, cells: int = CELLS) -> DataFrame:
    """``part, hash``: the hashes of differing rows; a null hash for a part that does not peel."""

    def peel(part: pd.DataFrame) -> pd.DataFrame:
        table = {
            int(r.cell): [int(r.count_), int(r.hash_low) + (int(r.hash_high) << _HALF), int(r.check_low) + (int(r.check_high) << _HALF)]
            for r in part.rename(columns={"count": "count_"}).itertuples()
        }
        found, todo = [], list(table)
        while todo:
            cell = table.get(todo.pop())
            if cell is None or cell[0] % PRIME == 0:
                continue
            count, number, check = cell
            single = number * pow(count, -1, PRIME) % PRIME
            if _check(single) * count % PRIME != check % PRIME:
                continue
            found.append(single)
            for c in _cells_of(single, cells):
                left = table.setdefault(c, [0, 0, 0])
                left[0] -= count
                left[1] -= count * single
                left[2] -= count * _check(single)
                todo.append(c)
        if any(c[0] or c[1] % PRIME or c[2] % PRIME for c in table.values()):
            found = [None]
        return pd.DataFrame({"part": int(part["part"].iloc[0]), "hash": pd.array(found, "Int64")})

    return sketch.groupBy("part").applyInPandas(peel, "part int, hash long")  # at most `cells` rows


def reconciled_differences(before: DataFrame, after: DataFrame, parts: int = PARTS, cells: int = CELLS) -> DataFrame:
    """As :func:`poolweave.operators.quality.row_differences`, but equal rows stay where they are.

    Both sides are read twice; they should be tables.
    """
    if sorted(before.columns) != sorted(after.columns):
        raise ValueError("the two sides have different columns")
    found = materialize(peeled(difference_sketch(before, after, parts, cells), cells), "differing-hashes")
    columns = sorted(before.columns)
    return row_differences(
        differing_rows(before, found, columns, parts),
        differing_rows(after.select(*cols(before.columns)), found, columns, parts),
    )


def differing_rows(df: DataFrame, found: DataFrame, columns: Sequence[str], parts: int = PARTS) -> DataFrame:
    """The rows of the hashes found, and all rows of parts that did not peel."""
    number = _row_number(columns)
    keyed = df.withColumns({_HASH: number, _PART: F.pmod(number, F.lit(parts)).cast("int")})
    whole = [r["part"] for r in found.filter("hash IS NULL").select("part").distinct().collect()]  # at most `parts`
    hashes = found.filter("hash IS NOT NULL").select(F.col("hash").alias(_HASH)).distinct()
    some = lookup_join(keyed.filter(~F.col(_PART).isin(whole)), hashes, [_HASH], "left_semi", null_safe=False)
    return some.unionAll(keyed.filter(F.col(_PART).isin(whole))).drop(_HASH, _PART)
