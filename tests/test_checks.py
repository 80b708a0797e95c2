"""Every registered query against its SQL at the smallest scale, and the driver contract."""

from __future__ import annotations

import json
import os
import subprocess
import sys

import pytest
from compare import connect, difference

import __spark_entry__ as contract
from folioflow.checks import CHECKS

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(CHECKS))
def test_query_equals_sql(spark, con, name):
    query, sql = CHECKS[name]
    assert difference(spark, con, query, sql, SF_DIR) == ""


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    flagship = contract.entry(spark)
    rows = flagship.collect()
    assert len(rows) == 50 and all(r.title and r._content_hash for r in rows)
    assert flagship.columns == ["page_id", "url", "title", "slug", "_content_hash", "_missing_fields"]


def test_bench_prints_one_json_line():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "BENCH_SF_DIR": SF_DIR, "BENCH_CPUS": "2"}
    done = subprocess.run([sys.executable, "bench.py", "q_hash"], cwd=root, env=env, capture_output=True, text=True, timeout=300)
    report = json.loads(done.stdout.strip().splitlines()[-1])
    assert report["unit"] == "sec" and set(report["queries"]) == {"q_hash"}
