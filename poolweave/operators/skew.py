"""Joins that stay balanced when one key holds a large part of the rows.

Two situations occur in the pipeline:

* a wide table meets a key set or a lookup (:func:`lookup_join`): the small side
  is counted first and broadcast only below a bound, so that the wide rows need
  no shuffle at all; above the bound the join shuffles, hot keys salted;
* two wide tables meet (:func:`balanced_left_join`): the rows per key are counted
  on the key columns alone; keys above ``hot_rows`` are salted on both sides.

The list of hot keys is complete: at most one key for every ``hot_rows`` rows. It is a
table that is never collected; a list too long to broadcast meets the rows in a shuffled
join, whose large partitions are split at run time. It decides about balance only, never
about the result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poolweave.functions.columns import col, cols
from poolweave.session import materialize

HOT_ROWS = 1_000_000
MAX_BROADCAST_ROWS = 500_000  # of keys and ids: some 100 MB in memory
FAN_OUT = 64

_HOT = "__hot"
_LEFT_HOT, _RIGHT_HOT = "__left_hot", "__right_hot"
_LEFT_SALT, _RIGHT_SALT = "__left_salt", "__right_salt"
_MATCHED = "__matched"


def key_condition(
    left: Sequence[Column], right: Sequence[Column], null_safe: bool = True
) -> Column:
    """Equality of two key lists; ``null_safe`` lets a null meet a null."""
    parts = [a.eqNullSafe(b) if null_safe else a == b for a, b in zip(left, right)]
    return reduce(lambda a, b: a & b, parts)


def _prefixed(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({k: prefix + k for k in keys})


def _spread(df: DataFrame, fan_out: int) -> Column:
    """A salt from row content and task, the same again when a task is retried.

    The task number keeps equal copies of one row apart.
    """
    return F.pmod(F.xxhash64(*cols(df.columns), F.spark_partition_id()), F.lit(fan_out))


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """Keys with at least ``hot_rows`` rows."""
    return (
        df.groupBy(*cols(keys))
        .agg(F.count(F.lit(1)).alias(_HOT))
        .filter(F.col(_HOT) >= hot_rows)
    )


def lookup_join(
    wide: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    *,
    null_safe: bool = True,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
    fan_out: int = FAN_OUT,
    max_listed: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Join wide rows to a narrow lookup.

    ``how`` is ``left``, ``inner``, ``left_semi`` or ``left_anti``. ``lookup``
    should be cheap to read (a manifest, or the output of ``materialize``): it is
    counted here, and read once more in the join. Up to ``max_listed`` hot keys are
    broadcast.
    """
    small = lookup.count() <= max_broadcast_rows
    right = _prefixed(lookup, keys, "__lookup_")
    right_keys = ["__lookup_" + k for k in keys]
    condition = key_condition(cols(keys), cols(right_keys), null_safe)
    if small:
        return wide.join(F.broadcast(right), condition, how).drop(*right_keys)

    hot = hot_keys(wide, keys, hot_rows).select(*cols(keys), F.lit(True).alias(_HOT))
    hot_list = _listed(_prefixed(hot, keys, "__hot_"), max_listed)
    if hot_list is None:
        return wide.join(right, condition, how).drop(*right_keys)

    wide_salted = _mark(wide, hot_list, keys, "__hot_").withColumn(
        _LEFT_SALT, F.when(F.col(_HOT), _spread(wide, fan_out)).otherwise(F.lit(0))
    )
    right_salted = _mark(right, hot_list, right_keys, "__hot_", keys).withColumn(
        _LEFT_SALT, F.explode(_all_salts(F.col(_HOT), fan_out))
    )
    right_salted = right_salted.drop(_HOT).withColumnRenamed(_LEFT_SALT, _RIGHT_SALT)
    joined = wide_salted.drop(_HOT).join(
        right_salted, condition & (F.col(_LEFT_SALT) == F.col(_RIGHT_SALT)), how
    )
    return joined.drop(_LEFT_SALT, _RIGHT_SALT, *right_keys)


def balanced_left_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    *,
    marker: str,
    null_safe: bool = True,
    hot_rows: int = HOT_ROWS,
    fan_out: int = FAN_OUT,
    max_listed: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Left join of two wide tables, fan-out allowed, both key columns kept.

    ``marker`` is a new column: true on rows with a partner, null on rows without.

    Rows of a key that is hot on the left are dealt out over ``fan_out`` tasks and
    meet all right rows of that key there; likewise for keys hot on the right. A
    left row of a right-hot key visits every task that holds right rows of the key;
    visits that find none are dropped afterwards, which is safe because such a key
    is known to have right rows. Up to ``max_listed`` hot keys are broadcast.
    """
    left_keys = [a for a, _ in on]
    right_keys = [b for _, b in on]
    right = right.withColumn(marker, F.lit(True))
    condition = key_condition(cols(left_keys), cols(right_keys), null_safe)

    if not null_safe:
        # A missing key has no partner then, so such right rows cannot be hot.
        for key in right_keys:
            right = right.filter(col(key).isNotNull())
    hot = _hot_on_either_side(left, right, left_keys, right_keys, hot_rows)
    hot_list = _listed(_prefixed(hot, left_keys, "__hot_"), max_listed)
    if hot_list is None:
        return left.join(right, condition, "left")

    def marked(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        same = key_condition(cols(keys), cols("__hot_" + k for k in left_keys))
        joined = df.join(hot_list, same, "left").drop(*("__hot_" + k for k in left_keys))
        return joined.withColumns(
            {f: F.coalesce(f, F.lit(False)) for f in (_LEFT_HOT, _RIGHT_HOT)}
        )

    left_side = (
        marked(left, left_keys)
        .withColumn(
            _LEFT_SALT, F.when(F.col(_LEFT_HOT), _spread(left, fan_out)).otherwise(F.lit(0))
        )
        .withColumn(_RIGHT_SALT, F.explode(_all_salts(F.col(_RIGHT_HOT), fan_out)))
        .drop(_LEFT_HOT)
    )
    right_side = (
        marked(right, right_keys)
        .withColumn(
            _RIGHT_SALT,
            F.when(F.col(_RIGHT_HOT), _spread(right, fan_out)).otherwise(F.lit(0)),
        )
        .withColumn(_LEFT_SALT, F.explode(_all_salts(F.col(_LEFT_HOT), fan_out)))
        .drop(_LEFT_HOT, _RIGHT_HOT)
        .withColumnsRenamed({_LEFT_SALT: "__r" + _LEFT_SALT, _RIGHT_SALT: "__r" + _RIGHT_SALT})
    )
    salts = (F.col(_LEFT_SALT) == F.col("__r" + _LEFT_SALT)) & (
        F.col(_RIGHT_SALT) == F.col("__r" + _RIGHT_SALT)
    )
    return (
        left_side.join(right_side, condition & salts, "left")
        .filter(~(F.col(_RIGHT_HOT) & col(marker).isNull()))
        .drop(
            _RIGHT_HOT, _LEFT_SALT, _RIGHT_SALT, "__r" + _LEFT_SALT, "__r" + _RIGHT_SALT
        )
    )


def _all_salts(is_hot: Column, fan_out: int) -> Column:
    everywhere = F.sequence(F.lit(0).cast("long"), F.lit(fan_out - 1).cast("long"))
    return F.when(is_hot, everywhere).otherwise(F.array(F.lit(0).cast("long")))


def _listed(hot: DataFrame, max_listed: int) -> DataFrame | None:
    """The landed list of hot keys, to be broadcast while it is short; None without any."""
    landed = materialize(hot, "hot-keys")
    rows = landed.count()
    if not rows:
        return None
    return F.broadcast(landed) if rows <= max_listed else landed.hint("shuffle_merge")


def _mark(
    df: DataFrame,
    hot_list: DataFrame,
    df_keys: Sequence[str],
    prefix: str,
    hot_names: Sequence[str] | None = None,
) -> DataFrame:
    """Add the boolean column ``__hot``."""
    names = [prefix + k for k in (hot_names or df_keys)]
    joined = df.join(hot_list, key_condition(cols(df_keys), cols(names)), "left")
    return joined.drop(*names).withColumn(_HOT, F.coalesce(_HOT, F.lit(False)))


def _hot_on_either_side(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str],
    right_keys: Sequence[str],
    hot_rows: int,
) -> DataFrame:
    """The hot keys of both sides: the key, hot on the left, hot on the right."""
    left_hot = hot_keys(left, left_keys, hot_rows)
    right_hot = hot_keys(right, right_keys, hot_rows).toDF(*left_keys, _HOT)
    both = left_hot.withColumns({_LEFT_HOT: F.lit(True), _RIGHT_HOT: F.lit(False)}).unionAll(
        right_hot.withColumns({_LEFT_HOT: F.lit(False), _RIGHT_HOT: F.lit(True)})
    )
    return both.groupBy(*cols(left_keys)).agg(
        F.max(_LEFT_HOT).alias(_LEFT_HOT), F.max(_RIGHT_HOT).alias(_RIGHT_HOT)
    )
