"""Queries on the test tables, each next to the SQL it must agree with."""

from poolweave.catalog import checks, collateral, country, files, fingerprints, harmonise
from poolweave.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "checks", "collateral", "country", "files", "fingerprints", "harmonise"]
