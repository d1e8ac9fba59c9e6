"""One country per pool, found by a strict priority of columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from poolweave.functions.columns import col, cols
from poolweave.functions.geo import (
    UNKNOWN_COUNTRY,
    pool_id_country,
    region_country,
    two_letter_country,
)
from poolweave.operators.pools import BUCKETS

# Evidence columns, strongest first, and how each is read.
CODE, REGION, REGION_WITHOUT_NO_DATA = "code", "region", "region_without_no_data"
EVIDENCE = {
    "RREL81": CODE,
    "RREL84": CODE,
    "RREC6": REGION,
    "RREL11": REGION_WITHOUT_NO_DATA,
    "AR129": REGION_WITHOUT_NO_DATA,
    "NPEL20": CODE,
    "NPEL23": CODE,
}
LIMIT_FAN_OUT = 64


def _reading(name: str, exclude_no_data_everywhere: bool) -> Column:
    kind = EVIDENCE[name]
    if kind == CODE:
        return two_letter_country(col(name))
    return region_country(
        col(name), exclude_no_data_everywhere or kind == REGION_WITHOUT_NO_DATA
    )


def first_rows(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    rows: int,
    row_in_file: str | None = None,
) -> DataFrame:
    """The first ``rows`` rows of each group.

    A group's first rows are among the first rows of its own files: if the table
    knows the place of a row in its file, everything else is filtered in the scan.
    What is left is limited per group and salt before it is limited per group, so the
    last step sees a bounded number of rows even of a group read by very many tasks.
    """
    if row_in_file is not None:
        df = df.filter(col(row_in_file) < rows)
    salted = df.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(LIMIT_FAN_OUT)))
    return _limited(_limited(salted, [*group, "__salt"], order, rows), group, order, rows).drop(
        "__salt"
    )


def _limited(
    df: DataFrame, group: Sequence[str], order: Sequence[str], rows: int
) -> DataFrame:
    place = Window.partitionBy(*cols(group)).orderBy(*cols(order))
    return (
        df.withColumn("__place", F.row_number().over(place))
        .filter(F.col("__place") <= rows)
        .drop("__place")
    )


def detect_country(
    df: DataFrame,
    pool: Sequence[str] = ("pool_id",),
    order: Sequence[str] = ("position",),
    *,
    sample_rows: int | None = None,
    row_in_file: str | None = None,
    exclude_no_data_everywhere: bool = False,
    aliases: Mapping[str, str] | None = None,
) -> DataFrame:
    """``pool…, country`` for every pool; the first pool column is its id.

    The first usable value of the strongest column counts, then the pool id, then
    ``UNKNOWN``. ``order`` gives the row order in a pool; all its rows are looked at,
    or only the first ``sample_rows`` where that is asked for.
    """
    evidence = [c for c in EVIDENCE if c in df.columns]
    places = [c for c in (*order, *([row_in_file] if row_in_file else [])) if c not in pool]
    wanted = list(dict.fromkeys([*pool, *places, *evidence]))
    rows = df.select(*cols(wanted))
    if sample_rows is not None:
        rows = first_rows(rows, pool, order, sample_rows, row_in_file)

    place = F.struct(*cols(order))
    levels = {c: _reading(c, exclude_no_data_everywhere) for c in evidence}
    found = rows.groupBy(*cols(pool)).agg(
        F.count(F.lit(1)).alias("__rows"),
        *(
            F.min_by(value, F.when(value.isNotNull(), place)).alias(c)
            for c, value in levels.items()
        ),
    )
    country = _decided(cols(evidence), col(pool[0]), aliases)
    return found.select(*cols(pool), country.alias("country"))


def _decided(values: Sequence[Column], pool_id: Column, aliases: Mapping[str, str] | None) -> Column:
    """The strongest value there is, then the pool id, then ``UNKNOWN``."""
    country = F.coalesce(*values, pool_id_country(pool_id.cast("string")), F.lit(UNKNOWN_COUNTRY))
    if aliases:
        names = F.create_map(*(F.lit(x) for pair in aliases.items() for x in pair))
        country = F.coalesce(names[country], country)
    return country


def country_evidence(
    df: DataFrame,
    pool: Sequence[str] = ("pool_id",),
    order: Sequence[str] = ("position",),
    *,
    exclude_no_data_everywhere: bool = False,
) -> DataFrame:
    """``pool…, evidence``: per evidence column its first usable value and where it stands.

    What a country depends on, in one row per pool. It can be stored and merged with the
    evidence of rows that arrive later (:func:`merged_evidence`), so that old rows need
    not be read again. ``order`` columns must have the same types every time.
    """
    place = F.struct(*cols(order))
    found = df.groupBy(*cols(pool)).agg(
        *(
            F.min(F.when(value.isNotNull(), F.struct(place.alias("place"), value.alias("value")))).alias(c)
            for c in EVIDENCE
            if c in df.columns
            for value in (_reading(c, exclude_no_data_everywhere),)
        )
    )
    missing = F.lit(None).cast(_evidence_type(df, order))
    columns = [col(c) if c in found.columns else missing for c in EVIDENCE]
    return found.select(*cols(pool), F.struct(*(v.alias(c) for c, v in zip(EVIDENCE, columns))).alias("evidence"))


def _evidence_type(df: DataFrame, order: Sequence[str]) -> str:
    places = ", ".join(f"`{c}`: {df.schema[c].dataType.simpleString()}" for c in order)
    return f"struct<place: struct<{places}>, value: string>"


def merged_evidence(states: Sequence[DataFrame], pool: Sequence[str] = ("pool_id",)) -> DataFrame:
    """One state of several: of each column the value that stands first."""
    both = states[0]
    for state in states[1:]:
        both = both.unionByName(state)
    return both.groupBy(*cols(pool)).agg(
        F.struct(*(F.min(F.col("evidence")[c]).alias(c) for c in EVIDENCE)).alias("evidence")
    )


def country_of_evidence(
    state: DataFrame, pool: Sequence[str] = ("pool_id",), *, aliases: Mapping[str, str] | None = None
) -> DataFrame:
    """``pool…, country``, as :func:`detect_country` finds it from all rows."""
    values = [F.col("evidence")[c]["value"] for c in EVIDENCE]
    return state.select(*cols(pool), _decided(values, col(pool[0]), aliases).alias("country"))


def country_statistics(index: DataFrame) -> DataFrame:
    """Files, size and files per bucket of each country.

    ``index`` has ``country, bucket, length`` per pool file.
    """
    return index.groupBy("country").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("length").alias("bytes"),
        *(F.count_if(F.col("bucket") == b).alias(b) for b in BUCKETS),
    )
