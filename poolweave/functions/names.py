"""File names and pool identifiers as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the naming scheme of the regulatory files,
# 1_<asset type>_<category>_<identifier>_<date>_<sequence>.csv
FILE_NAME_PATTERN = r"^1_(\w+)_(UE|Collateral)_(.+)_(\d{4}-\d{2}-\d{2})_(\d+)\.csv$"
FILE_NAME_FIELDS = ("asset_type", "category", "identifier", "date", "sequence")


_SEPARATOR = "\0"  # cannot occur in a file name
_PARTS = "__name_parts"


def with_name_fields(
    df: DataFrame,
    name: str,
    fields: Sequence[str] = FILE_NAME_FIELDS,
    *,
    matching_only: bool = False,
) -> DataFrame:
    """Add the parts of a file name; null, or no row, where the name has another form.

    The pattern takes the name apart in one go, and the fields pick their part.
    """
    marked = F.regexp_replace(
        F.col(name),
        FILE_NAME_PATTERN,
        _SEPARATOR.join(f"${i}" for i in range(1, len(FILE_NAME_FIELDS) + 1)),
    )
    split = df.withColumn(_PARTS, F.split(marked, _SEPARATOR))
    matches = F.size(_PARTS) == len(FILE_NAME_FIELDS)
    if matching_only:
        split = split.filter(matches)
    parts = {f: F.col(_PARTS)[i] for i, f in enumerate(FILE_NAME_FIELDS) if f in fields}
    return split.withColumns({f: F.when(matches, part) for f, part in parts.items()}).drop(_PARTS)


def merged_name(loan_file_name: Column) -> Column:
    """Name of the joined file, made from the name of the loan file."""
    return F.replace(loan_file_name, F.lit("_UE_"), F.lit("_UE_Collateral_"))


def ecb_pool_id(name: Column) -> Column:
    """Text before the first underscore."""
    return F.split(name, "_")[0]


def esma_pool_id(name: Column) -> Column:
    """Third part from the end, null when the name has fewer parts."""
    return F.try_element_at(F.split(name, "_"), F.lit(-3))


def safe_pool_id(pool_id: Column) -> Column:
    """A pool id that can stand in a path."""
    return F.translate(pool_id, "/\\", "__")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def decoded(uri_part: Column) -> Column:
    """Undo the URI escaping of the file metadata columns; ``+`` stays ``+``."""
    return F.url_decode(F.replace(uri_part, F.lit("+"), F.lit("%2B")))


def month(date: Column) -> Column:
    """``YYYY-MM`` of an ISO date held as text."""
    return F.substring(date, 1, 7)
