"""The operators bound to the given tables, and the same results in SQL."""

from clipledger.queries import content, files, ledger, work  # noqa: F401 - they register
from clipledger.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
