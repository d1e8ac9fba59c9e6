"""Texts that stand for a missing value."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poolweave.functions.columns import col, cols

# What the usual dataframe CSV reader takes for missing.
RAW_FILE_NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Between the stages only the empty text stands for a missing value.
EMPTY_ONLY = ("",)

FEW_COLUMNS = 24
_VALUES = "__values"


def null_if_token(value: Column, tokens: Iterable[str]) -> Column:
    return F.when(~value.isin(*tokens), value)


def apply_null_tokens(
    df: DataFrame, tokens: Iterable[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Replace null tokens in the given (default: all) text columns.

    Hundreds of columns go through one array, so that one small expression is
    compiled and kept hot instead of one per column; a few columns are replaced one by
    one, which leaves the others prunable.
    """
    tokens = tuple(tokens)
    wanted = [c for c in df.columns if columns is None or c in set(columns)]
    if not tokens or not wanted:
        return df
    if len(wanted) <= FEW_COLUMNS:
        return df.withColumns({c: null_if_token(col(c), tokens) for c in wanted})
    others = [c for c in df.columns if c not in set(wanted)]
    values = F.transform(F.array(*cols(wanted)), lambda value: null_if_token(value, tokens))
    place = {c: i for i, c in enumerate(wanted)}
    return df.select(*cols(others), values.alias(_VALUES)).select(
        *(F.col(_VALUES)[place[c]].alias(c) if c in place else col(c) for c in df.columns)
    )
