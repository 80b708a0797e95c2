"""Registered queries: each runs an operator over whole tables, with the same
result stated independently in SQL."""

from folioflow.checks import change, discovery, extraction, library, runs, text  # noqa: F401
from folioflow.checks.registry import CHECKS, oracle_sql, queries

__all__ = ["CHECKS", "oracle_sql", "queries"]
