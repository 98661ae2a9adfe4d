"""Named queries over the test tables and their DuckDB oracle SQL."""

from tidemark.plans.catalog import QUERIES
from tidemark.plans.oracle import ORACLE_SQL

__all__ = ["QUERIES", "ORACLE_SQL"]
