"""Loan-level panels from two regulatory sources, as Spark jobs."""

from poolweave.operators.collateral import join_collateral, join_statistics, pair_files
from poolweave.operators.columns import align, non_empty_columns, union_aligned
from poolweave.operators.country import country_statistics, detect_country
from poolweave.operators.mapping import (
    forward_mapping,
    prepare_ecb,
    prepare_esma,
    reverse_mapping,
)
from poolweave.operators.ordering import sort_panel, with_position
from poolweave.operators.pools import classify_pools, overlap_report, pending, pool_sizes
from poolweave.operators.prefer import prefer_source
from poolweave.operators.quality import (
    integrity_report,
    loan_checksum,
    row_differences,
    sort_violations,
)
from poolweave.session import build_session

__all__ = [
    "align",
    "build_session",
    "classify_pools",
    "country_statistics",
    "detect_country",
    "forward_mapping",
    "integrity_report",
    "join_collateral",
    "join_statistics",
    "loan_checksum",
    "non_empty_columns",
    "overlap_report",
    "pair_files",
    "pending",
    "pool_sizes",
    "prefer_source",
    "prepare_ecb",
    "prepare_esma",
    "reverse_mapping",
    "row_differences",
    "sort_panel",
    "sort_violations",
    "union_aligned",
    "with_position",
]
