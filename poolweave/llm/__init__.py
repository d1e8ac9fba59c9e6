"""Operators for preparing training text, with their queries."""

from poolweave.llm.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
