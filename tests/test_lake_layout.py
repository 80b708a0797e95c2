"""The curve order of the content table: what a scan leaves out, and pages of a list."""

from __future__ import annotations

import glob
import random

import pyarrow.parquet as pq
import pytest

from folioflow.operators.lake import fetch_items, list_items
from folioflow.operators.lake_layout import curve_cuts, curve_place, list_page, write_clustered

ITEM = "source_url string, brand string, category string, categories array<string>, author string, date_published string, body string"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rng = random.Random(9)
    rows = []
    for i in range(20_000):
        brand = rng.choice([None, "a", "a", "a", *"bcdefgh"])  # one brand holds a third
        day = None if i % 50 == 0 else f"2024-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}"
        rows.append((f"/i/{i}", brand, f"c{rng.randint(0, 9)}", ["x"], f"w{i % 7}", day, "text " * rng.randint(1, 30)))
    rows += [(None, None, None, None, None, None, None)]
    path = str(tmp_path_factory.mktemp("lake") / "items")
    write_clustered(spark.createDataFrame(rows, ITEM), path, files=4, group_bytes=64 << 10, keys_per_group=1000)
    return rows, path


def groups(path):
    return [g for f in sorted(glob.glob(f"{path}/*.parquet")) for m in [pq.ParquetFile(f).metadata] for g in map(m.row_group, range(m.num_row_groups))]


def may_hold(group, column, low, high):
    at = [c for c in map(group.column, range(group.num_columns)) if c.path_in_schema == column][0].statistics
    return at.has_min_max and at.min <= high and at.max >= low


def test_rows_are_kept_and_row_groups_are_boxes(spark, stored):
    rows, path = stored
    assert spark.read.parquet(path).count() == len(rows)
    every = groups(path)
    assert len(every) >= 30
    quarter = [g for g in every if may_hold(g, "date_published", "2024-04-01", "2024-06-30")]
    brand = [g for g in every if may_hold(g, "brand", "f", "f")]
    both = [g for g in quarter if g in brand]
    assert len(quarter) < 0.6 * len(every) and len(brand) < 0.6 * len(every) and len(both) < 0.35 * len(every)


def scanned(df):
    """Rows that left the scan, after row groups were left out."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    leaves = node.collectLeaves()
    return leaves.apply(0).metrics().apply("numOutputRows").value()


def test_scans_leave_row_groups_out(spark, stored):
    rows, path = stored
    lake = spark.read.parquet(path)
    hits = lake.filter("brand = 'f' and date_published >= '2024-04-01' and date_published <= '2024-06-30'")
    assert hits.count() == sum(r[1] == "f" and "2024-04-01" <= (r[5] or "") <= "2024-06-30" for r in rows)
    assert scanned(hits) < 0.35 * len(rows)
    one = fetch_items(lake, ["/i/777"])
    assert [r.source_url for r in one.collect()] == ["/i/777"]
    assert scanned(one) < 0.1 * len(rows)  # min and max of the ids say nothing here; the Bloom filters do


@pytest.mark.parametrize("filters", [{"brand": "b", "author": "w3"}, {"published_from": "2024-12-20"}, {"category": "c3", "brand": "h"}])
def test_pages_joined_are_the_list(spark, stored, filters):
    lake = spark.read.parquet(stored[1])
    key = lambda r: (r.date_published, r.brand, r.source_url)
    whole = sorted(map(key, list_items(lake, **filters).collect()), key=str)
    got, last = [], None
    while page := list_page(lake, 60, last, **filters).collect():
        got += [key(r) for r in page]
        last = page[-1].asDict()
    assert sorted(got, key=str) == whole and len(got) == len(set(got))
    days = [d for d, _, _ in got]
    assert [d for d in days if d] == sorted((d for d in days if d), reverse=True) and days == [d for d in days if d] + [d for d in days if not d]


def test_curve_place_of_nothing(spark):
    empty = spark.createDataFrame([], ITEM)
    assert empty.select(curve_place(curve_cuts(empty))).collect() == []
