"""Shared content over runs, kept up to date by what a batch changes.

Two tables: ``members`` holds signed counts of URLs per brand and body (an item that is added
counts one up, a body that is replaced one down), ``view`` the counts of each body after the last
batch that touched it. A batch reads the buckets of the bodies it touched and nothing else; the
URLs of a body are counted by an aggregate, never gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.session import cut_lineage, join_path
from folioflow.streaming.state import SeenTable, VersionedTable

BODY = ["brand", "content_hash"]
MEMBERS = "brand string, content_hash string, url string, n bigint"
VIEW = "brand string, content_hash string, n_urls bigint, first_url string, last_url string"


class _Members(VersionedTable):
    def gathered(self, rows: DataFrame) -> DataFrame:
        """URLs that have the body, once each."""
        return rows.groupBy(*BODY, "url").agg(F.sum("n").alias("n")).filter("n > 0")


class _View(VersionedTable):
    def gathered(self, rows: DataFrame) -> DataFrame:
        counts = F.struct("n_urls", "first_url", "last_url")
        last = rows.groupBy(*BODY).agg(F.max_by(counts, "_run").alias("_last"))
        return last.select(*BODY, "_last.*").filter("n_urls > 0")


class SharedView:
    """Shared content of a library below one root."""

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.members = _Members(spark, join_path(root, "members"), T._parse_datatype_string(MEMBERS), BODY, buckets)
        self.view = _View(spark, join_path(root, "view"), T._parse_datatype_string(VIEW), BODY, buckets)

    def fold(self, current: DataFrame, seen: DataFrame, batch: int) -> None:
        """Take in a batch: ``current`` (brand, url, content_hash) has the last version of each of its
        items, ``seen`` the state before it (``SeenTable.before``). Empty bodies count as none."""
        old = seen.select("brand", "url", F.col("content_hash").alias("_old"))
        now = cut_lineage(current.select("brand", "url", "content_hash").join(old, ["brand", "url"], "left"))
        changed = now.filter(F.col("_old").isNull() | (F.col("_old") != F.col("content_hash")))
        up = changed.select(*BODY, "url", F.lit(1).cast("long").alias("n"))
        down = changed.filter("_old is not null").select(
            "brand", F.col("_old").alias("content_hash"), "url", F.lit(-1).cast("long").alias("n")
        )
        self.members.write_delta(up.unionByName(down).filter("content_hash <> ''"), batch)
        touched = cut_lineage(self.members.read_before(batch + 1).filter(F.col("_run") == batch).select(*BODY).distinct())
        left = self.members.gathered(self.members.read_before(batch + 1, touched))
        counts = left.groupBy(*BODY).agg(
            F.count("*").alias("n_urls"), F.min("url").alias("first_url"), F.max("url").alias("last_url")
        )
        counted = touched.join(counts, BODY, "left").withColumn("n_urls", F.coalesce("n_urls", F.lit(0).cast("long")))
        self.view.write_delta(counted, batch)

    def shared(self, batch: int) -> DataFrame:
        """Bodies with several URLs after ``batch``: brand, content_hash, n_urls, first_url, last_url."""
        return self.view.gathered(self.view.read_before(batch + 1)).filter("n_urls > 1")

    def compact(self, batch: int) -> None:
        self.members.compact(batch)
        self.view.compact(batch)


def fold_batch(items: DataFrame, state: SeenTable, view: SharedView, batch: int) -> None:
    """Fold the last versions ``items`` (brand, url, content_hash, seen_at) of a batch into state and view."""
    view.fold(items, state.before(batch, items.select("brand", "url")), batch)
    state.write_delta(items, batch)
