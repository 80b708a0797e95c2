"""Registry of checked queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.sources.pages import read_table

Query = Callable[[SparkSession, str], DataFrame]
CHECKS: dict[str, tuple[Query, str | None]] = {}


def check(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name, with the SQL that gives the same rows."""

    def add(query: Query) -> Query:
        CHECKS[query.__name__] = (query, sql)
        return query

    return add


def queries() -> dict[str, Query]:
    return {name: query for name, (query, _) in CHECKS.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in CHECKS.items() if sql}


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return read_table(spark, root, name)


def joined(values: Column | str, sep: str = "|") -> Column:
    """An array as one text, null as the empty text."""
    return F.array_join(F.coalesce(values, F.array().cast("array<string>")), sep)


def text(*parts: Column | str) -> Column:
    """Concatenation of columns and literal texts (literals start with ``=``)."""
    cols = [F.lit(p[1:]) if isinstance(p, str) and p.startswith("=") else F.col(p) if isinstance(p, str) else p for p in parts]
    return F.concat(*[c.cast("string") for c in cols])
