"""Checks after a run: counts, keys, checksums, order, duplicates, previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from poolweave.functions.columns import SORT_KEYS, col, cols
from poolweave.operators.skew import key_condition
from poolweave.operators.sketches import exact_distinct

# Fixed values.
CHECKED_COLUMNS = ("RREL3", "RREC3", "RREL6", "RREL1", "source")
KEY_SEPARATOR = "|"
SPOT_LOANS = 5
PASS, FAIL = "PASS", "FAIL"
ISSUES = {
    "columns": "COLUMN COUNT MISMATCH",
    "names": "COLUMN NAMES DIFFER",
    "rows": "ROW COUNT MISMATCH",
    "unique_keys": "UNIQUE KEY COUNT MISMATCH",
    "distinct": "DISTINCT {} MISMATCH",
    "loan_checksum": "{} CHECKSUM MISMATCH",
    "row_checksum": "ROW CHECKSUM MISMATCH",
    "lost": "ONLY IN INPUT",
    "new": "ONLY IN OUTPUT",
}

_MISSING = "\0"


def composite_key(keys: Sequence[str] = SORT_KEYS) -> Column:
    """Keys as one text: null if the first is null, other nulls count as empty."""
    first, *rest = keys
    parts = [col(first)]
    for k in rest:
        parts += [F.lit(KEY_SEPARATOR), F.coalesce(col(k), F.lit(""))]
    return F.concat(*parts)


def row_counts(df: DataFrame, group: Sequence[str]) -> DataFrame:
    return df.groupBy(*cols(group)).agg(F.count(F.lit(1)).alias("rows"))


def unique_keys(df: DataFrame, group: Sequence[str], keys: Sequence[str] = SORT_KEYS) -> DataFrame:
    """Exact number of different keys per group."""
    keyed = df.select(*cols(group), composite_key(keys).alias("__key"))
    return keyed.groupBy(*cols(group)).agg(F.count_distinct("__key").alias("unique_keys"))


def distinct_values(
    df: DataFrame,
    group: Sequence[str],
    columns: Sequence[str] = CHECKED_COLUMNS,
    *,
    approximate: bool = False,
) -> DataFrame:
    """Different values per column and group, as ``distinct_<column>``."""
    available = [c for c in columns if c in df.columns and c not in group]
    if not approximate:
        return exact_distinct(df, group, {"distinct_" + c: col(c) for c in available})
    return df.groupBy(*cols(group)).agg(
        *(F.approx_count_distinct(col(c)).alias("distinct_" + c) for c in available)
    )


def _digest(text: Column) -> Column:
    """60 bits of a text's MD5 as an exact number."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(20,0)")


def row_text(columns: Sequence[str]) -> Column:
    """A row as one text, with field lengths so that no two rows look alike."""
    parts = []
    for c in columns:
        value = col(c).cast("string")
        parts.append(
            F.when(value.isNull(), F.lit("-;")).otherwise(
                F.concat(F.length(value).cast("string"), F.lit(":"), value, F.lit(";"))
            )
        )
    return F.concat(*parts)


def row_hash(columns: Sequence[str]) -> Column:
    """A row as one 64-bit number, with missing values told from their neighbours."""
    return F.xxhash64(*(F.coalesce(col(c).cast("string"), F.lit(_MISSING)) for c in columns))


def loan_checksum(df: DataFrame, group: Sequence[str], loan: str = "RREL3") -> DataFrame:
    """Checksum of a group's loan ids with repetitions, whatever the row order.

    Concatenating the sorted ids and hashing the text tells the same sets apart, but
    needs a whole country in one row. Here every id contributes a number instead,
    and numbers add up in any order and any number of tasks.
    """
    return df.groupBy(*cols(group)).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(_digest(F.coalesce(col(loan), F.lit("")))).cast("string").alias("loan_checksum"),
    )


def row_checksum(
    df: DataFrame, group: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """The same over whole rows, so that any changed field shows."""
    columns = sorted(c for c in (columns or df.columns) if c not in group)
    return df.groupBy(*cols(group)).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(_digest(row_text(columns))).cast("string").alias("row_checksum"),
    )


def out_of_order(keys: Sequence[str], previous: Sequence[str]) -> Column:
    """A row sorts before its predecessor; comparisons with null do not count."""
    condition = F.lit(False)
    equal_so_far = F.lit(True)
    for k, p in zip(keys, previous):
        condition = condition | (equal_so_far & (col(k) < col(p)))
        equal_so_far = equal_so_far & (col(k) == col(p))
    return col(previous[0]).isNotNull() & F.coalesce(condition, F.lit(False))


def sort_violations(
    df: DataFrame,
    group: Sequence[str],
    chunk: Sequence[str],
    order: Sequence[str],
    keys: Sequence[str] = SORT_KEYS,
    partitions: int | None = None,
) -> DataFrame:
    """Rows per group, and how many sort before the row stored ahead of them.

    ``chunk`` columns cut a group into pieces in storage order (file and block),
    ``order`` columns give the place of a row in its piece. Rows are compared inside
    the pieces; then each piece's first row with the last row of the piece before,
    for which one row per piece is enough. Pieces are dealt to ``partitions`` tasks, or
    to as many as the session says.
    """
    previous = ["__previous_" + k for k in keys]
    inside = Window.partitionBy(*cols([*group, *chunk])).orderBy(*cols(order))
    rows = df.select(*cols(dict.fromkeys([*group, *chunk, *order, *keys])))
    if partitions is not None:
        rows = rows.repartition(partitions, *cols([*group, *chunk]))
    compared = rows.withColumns({p: F.lag(col(k)).over(inside) for k, p in zip(keys, previous)})
    place, values = F.struct(*cols(order)), F.struct(*cols(keys))
    pieces = compared.groupBy(*cols([*group, *chunk])).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(out_of_order(keys, previous)).alias("__inside"),
        F.min_by(values, place).alias("__first"),
        F.max_by(values, place).alias("__last"),
    )
    between = Window.partitionBy(*cols(group)).orderBy(*cols(chunk))
    borders = pieces.withColumn("__before", F.lag("__last").over(between)).select(
        *cols(group),
        "rows",
        "__inside",
        *(F.col("__first")[k].alias(k) for k in keys),
        *(F.col("__before")[k].alias(p) for k, p in zip(keys, previous)),
    )
    return borders.groupBy(*cols(group)).agg(
        F.sum("rows").alias("rows"),
        (
            F.sum("__inside") + F.count_if(out_of_order(keys, previous))
        ).alias("violations"),
    )


def row_differences(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows with different numbers of copies on the two sides, and both numbers.

    Compares every row, not a sample, in one shuffle with copies counted first.
    """
    columns = before.columns
    if sorted(columns) != sorted(after.columns):
        raise ValueError("the two sides have different columns")
    both = before.withColumn("__side", F.lit(0)).unionByName(
        after.withColumn("__side", F.lit(1))
    )
    return (
        both.groupBy(*cols(columns))
        .agg(
            F.count_if(F.col("__side") == 0).alias("copies_before"),
            F.count_if(F.col("__side") == 1).alias("copies_after"),
        )
        .filter(F.col("copies_before") != F.col("copies_after"))
    )


def integrity_report(
    before: DataFrame,
    after: DataFrame,
    group: Sequence[str] = ("country",),
    *,
    keys: Sequence[str] = SORT_KEYS,
    columns: Sequence[str] = CHECKED_COLUMNS,
    groups: Sequence[str] | None = None,
) -> DataFrame:
    """PASS or FAIL per group with the list of differences found.

    Compares row counts, column names, unique keys, distinct values, the checksum of
    the loan ids and a checksum of the whole rows. ``groups`` limits the report to
    some values of the first group column. A group on one side only fails, with that as
    its issue.
    """
    if groups is not None:
        chosen = col(group[0]).isin(list(groups))
        before, after = before.filter(chosen), after.filter(chosen)
    shared = [c for c in before.columns if c in after.columns]
    names_differ = F.lit(before.columns != after.columns)
    counts_differ = F.lit(len(before.columns) != len(after.columns))
    checked = [c for c in columns if c in shared and c not in group]

    fields = sorted(c for c in shared if c not in group)

    def measured(df: DataFrame, prefix: str) -> DataFrame:
        # Rows and checksums meet in one row per group and task; only values are listed.
        values = {"unique_keys": composite_key(keys), **{"distinct_" + c: col(c) for c in checked}}
        sums = {"loan_checksum": row_hash([keys[0]]), "row_checksum": row_hash(fields)}
        added = df.groupBy(*cols(group)).agg(
            F.count(F.lit(1)).alias("rows"), *(F.sum(c.cast("decimal(38,0)")).alias(n) for n, c in sums.items())
        )
        counted = exact_distinct(df, group, values)
        same = key_condition(cols(group), cols("__counted_" + g for g in group))
        found = added.join(counted.withColumnsRenamed({g: "__counted_" + g for g in group}), same).drop(
            *("__counted_" + g for g in group)
        )
        return found.withColumnsRenamed({c: prefix + c for c in found.columns})

    left, right = measured(before, "b_"), measured(after, "a_")
    same_group = key_condition(cols("b_" + g for g in group), cols("a_" + g for g in group))
    measures = {
        "rows": ISSUES["rows"],
        "unique_keys": ISSUES["unique_keys"],
        **{"distinct_" + c: ISSUES["distinct"].format(c) for c in checked},
        "loan_checksum": ISSUES["loan_checksum"].format(keys[0]),
        "row_checksum": ISSUES["row_checksum"],
    }
    lost, new = F.col("a_rows").isNull(), F.col("b_rows").isNull()
    differences = F.array_compact(
        F.array(
            F.when(counts_differ, F.lit(ISSUES["columns"])),
            F.when(names_differ, F.lit(ISSUES["names"])),
            *(
                F.when(~col("b_" + m).eqNullSafe(col("a_" + m)), F.lit(text))
                for m, text in measures.items()
            ),
        )
    )
    issues = (
        F.when(lost, F.array(F.lit(ISSUES["lost"])))
        .when(new, F.array(F.lit(ISSUES["new"])))
        .otherwise(differences)
    )
    return (
        left.join(right, same_group, "full")
        .withColumn("issues", issues)
        .select(
            *(F.when(new, col("a_" + g)).otherwise(col("b_" + g)).alias(g) for g in group),
            F.when(F.size("issues") == 0, F.lit(PASS)).otherwise(F.lit(FAIL)).alias("status"),
            F.col("b_rows").alias("rows_before"),
            F.col("a_rows").alias("rows_after"),
            F.col("b_unique_keys").alias("unique_keys"),
            F.lit(len(before.columns)).alias("columns"),
            "issues",
        )
    )


def report_totals(report: DataFrame) -> DataFrame:
    """Groups checked, passed and failed, and rows in passed groups."""
    passed = F.col("status") == PASS
    return report.agg(
        F.count(F.lit(1)).alias("checked"),
        F.count_if(passed).alias("passed"),
        F.count_if(~passed).alias("failed"),
        F.coalesce(F.sum(F.when(passed, F.col("rows_before"))), F.lit(0)).alias("rows_verified"),
    )


def duplicate_groups(df: DataFrame, columns: Sequence[str], at_least: int = 1) -> DataFrame:
    """Rows per combination of the columns, from ``at_least`` rows on."""
    return (
        df.groupBy(*cols(columns))
        .agg(F.count(F.lit(1)).alias("cnt"))
        .filter(F.col("cnt") >= at_least)
    )


def loans_per_pool(df: DataFrame, columns: Sequence[str], loan: str = "RREL3") -> DataFrame:
    return df.groupBy(*cols(columns)).agg(
        F.count_distinct(col(loan)).alias("unique_loans"),
        F.count(F.lit(1)).alias("total_rows"),
    )


def long_series(
    df: DataFrame, keys: Sequence[str] = SORT_KEYS[:2], more_than: int = 3
) -> DataFrame:
    """Loan-collateral pairs with more than so many observations."""
    usable = [col(k).isNotNull() & (col(k) != "") for k in keys]
    for condition in usable:
        df = df.filter(condition)
    return (
        df.groupBy(*cols(keys)).agg(F.count(F.lit(1)).alias("obs")).filter(F.col("obs") > more_than)
    )


def series_rows(df: DataFrame, chosen: DataFrame, keys: Sequence[str] = SORT_KEYS[:2]) -> DataFrame:
    """All rows of the chosen loan-collateral pairs."""
    return df.join(chosen.select(*cols(keys)), list(keys), "left_semi")


def sample_values(df: DataFrame, column: str, n: int = SPOT_LOANS, seed: str = "") -> DataFrame:
    """``n`` different non-empty values, picked by hash: random-like, repeatable."""
    values = df.select(col(column)).filter(col(column).isNotNull() & (col(column) != "")).distinct()
    return values.orderBy(F.md5(F.concat(F.lit(seed), col(column))), col(column)).limit(n)


def head(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first rows in a stated order."""
    return df.orderBy(*(col(c).asc_nulls_last() for c in order)).limit(n)
