"""Registered queries that have SQL, on whole tables."""

from __future__ import annotations

import compare
import pytest

from folioflow.llm.queries import QUERIES, SQL

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    assert compare.difference(spark, compare.connect(DIR), QUERIES[name], SQL[name], DIR) == ""
