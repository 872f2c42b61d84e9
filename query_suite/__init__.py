"""Queries over the given tables, each with the SQL that must give the same rows."""

from query_suite import actions, jobs, matching, rules, tables, words  # noqa: F401
from query_suite.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
