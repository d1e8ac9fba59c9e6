"""Rules on column *names*, evaluated while a plan is built.

Nothing here touches data: the inputs are the headers of the files or the
columns of a DataFrame, the outputs are lists used in ``select`` and ``join``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the field-code scheme.
LOAN_KEY_SUFFIX = "L2"
COLLATERAL_KEY_SUFFIX = "C2"
COLLATERAL_SECURITY_SUFFIX = "C1"
MAX_FIELD_CODE_LENGTH = 6
COLLATERAL_METADATA = ("Sec_Id", "Pool_Cutoff_Date")
OVERLAP_SUFFIX = "_collateral"

SORT_KEYS = ("RREL3", "RREC3", "RREL6")


def col(name: str) -> Column:
    """A column by its exact name, also when the name holds dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def cols(names: Iterable[str]) -> list[Column]:
    return [col(name) for name in names]


def field_codes(columns: Iterable[str], suffix: str) -> list[str]:
    """Columns that are field codes (short names) with the given ending."""
    return [c for c in columns if c.endswith(suffix) and len(c) <= MAX_FIELD_CODE_LENGTH]


def detect_join_key(
    loan_columns: Sequence[str], collateral_columns: Sequence[str]
) -> tuple[str, str] | None:
    """Pair ``<stem>L2`` of the loans with ``<stem'>C2`` of the collateral.

    A loan code ends in ``L2`` and its collateral code has ``C2`` in the same
    place (``RREL2``/``RREC2``). The first loan column with a partner wins.
    """
    partners = set(field_codes(collateral_columns, COLLATERAL_KEY_SUFFIX))
    for loan_key in field_codes(loan_columns, LOAN_KEY_SUFFIX):
        collateral_key = loan_key.removesuffix(LOAN_KEY_SUFFIX) + COLLATERAL_KEY_SUFFIX
        if collateral_key in partners:
            return loan_key, collateral_key
    return None


def join_key_error(loan_columns: Sequence[str], collateral_columns: Sequence[str]) -> str:
    """The message recorded for a pair whose join key cannot be found."""
    loans = [c for c in loan_columns if LOAN_KEY_SUFFIX in c]
    collateral = [c for c in collateral_columns if COLLATERAL_KEY_SUFFIX in c]
    return f"No join key: loan candidates {loans}, collateral candidates {collateral}"


def collateral_columns_to_drop(columns: Sequence[str]) -> list[str]:
    """Collateral columns that only repeat what the loan side already holds."""
    present = [c for c in COLLATERAL_METADATA if c in columns]
    return present + field_codes(columns, COLLATERAL_SECURITY_SUFFIX)


def overlap_renames(left: Sequence[str], right: Sequence[str]) -> dict[str, str]:
    """New names for right-hand columns that clash with a left-hand column."""
    renames = {c: c + OVERLAP_SUFFIX for c in right if c in set(left)}
    result = list(left) + [renames.get(c, c) for c in right]
    clashes = sorted({c for c in result if result.count(c) > 1})
    if clashes:
        raise ValueError(f"columns still clash after the overlap suffix: {clashes}")
    return renames


def sorted_union(headers: Iterable[Iterable[str]]) -> list[str]:
    """The union of several headers, in sorted order."""
    return sorted({name for header in headers for name in header})


def unique_header(names: Sequence[str]) -> list[str]:
    """Number repeated header names ``x``, ``x.1``, ``x.2`` …, left to right."""
    taken: set[str] = set(names)
    seen: dict[str, int] = {}
    result = []
    for name in names:
        if name not in seen:
            seen[name] = 0
            result.append(name)
            continue
        candidate = name
        while candidate in taken:
            seen[name] += 1
            candidate = f"{name}.{seen[name]}"
        taken.add(candidate)
        result.append(candidate)
    return result


def display_columns(columns: Sequence[str]) -> list[str]:
    """Columns worth showing in a preview: pool metadata and four key codes."""
    keys = [c for c in columns if c.endswith((LOAN_KEY_SUFFIX, COLLATERAL_KEY_SUFFIX))]
    return [c for c in [*COLLATERAL_METADATA, *keys[:4]] if c in columns]


def require_distinct_by_case(columns: Sequence[str], case_sensitive: bool) -> None:
    """Reject headers that differ only in case unless the session tells them apart."""
    if case_sensitive:
        return
    by_lower: dict[str, list[str]] = {}
    for name in columns:
        by_lower.setdefault(name.lower(), []).append(name)
    clashes = [names for names in by_lower.values() if len(set(names)) > 1]
    if clashes:
        raise ValueError(
            f"columns differ only in case: {clashes}; set spark.sql.caseSensitive=true"
        )


def require_unreserved(columns: Iterable[str], reserved: Iterable[str]) -> None:
    """Reject data columns that a later step would overwrite with its own."""
    clashes = sorted(set(columns) & set(reserved))
    if clashes:
        raise ValueError(f"columns have names the pipeline uses itself: {clashes}")


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    available = set(df.columns)
    return [n for n in names if n in available]
