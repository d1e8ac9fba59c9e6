"""Country evidence in single values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN_COUNTRY = "UNKNOWN"


def two_letter_country(value: Column) -> Column:
    """Upper-cased code if the value is exactly two letters, else null."""
    return F.when(value.rlike(r"\A\p{L}{2}\z"), F.upper(value))


def region_country(value: Column, exclude_no_data: bool) -> Column:
    """Country of a regional (NUTS) code: its first two characters if letters.

    ``exclude_no_data`` skips the "no data" codes, which start with ``ND``.
    """
    valid = value.rlike(r"\A\p{L}{2}")
    if exclude_no_data:
        valid = valid & ~value.startswith("ND")
    return F.when(valid, F.upper(F.substring(value, 1, 2)))


def pool_id_country(pool_id: Column) -> Column:
    """Country inside ids such as ``RMBMIT…``: characters five and six."""
    code = F.substring(pool_id, 5, 2)
    usable = pool_id.rlike(r"\ARMB[MS]") & code.rlike(r"\A\p{L}+\z")
    return F.when(usable, F.upper(code))
