"""Change detection per arriving item, as a stream with state.

Every key (brand, key) holds the hash it had last; an arriving version is new, unchanged or updated
against it, as in ``quality.detect_changes``. State lives in the query's checkpoint: a query that
is stopped, or whose executors are lost, goes on where its last complete micro-batch ended, and the
files of a batch that is played again replace their own output only.

Versions of one key inside a micro-batch are put in order there, so a micro-batch bounds what a task
holds of one key: narrow rows (key, hash, order), never bodies. Versions that arrive in a later
micro-batch count as later whatever their order says.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from folioflow.operators.quality import NEW, UNCHANGED, UPDATED
from folioflow.session import join_path, ship_package

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Changes(StatefulProcessor):
    def __init__(self, hash_col: str, order: Sequence[str], columns: Sequence[str]):
        self.hash_col, self.order, self.columns = hash_col, list(order), list(columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "content_hash string")

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802, N803
        self.last.update((initialState.iloc[0, 2],))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        part = pd.concat(list(rows), ignore_index=True)
        part.columns = self.columns  # names that begin with an underscore do not survive the way here
        part = part.sort_values(self.order, kind="stable", ignore_index=True)
        hashes = part[self.hash_col]
        before = hashes.shift(1)
        known = self.last.get()
        first = known[0] if known is not None else None
        change = (hashes == before).map({True: UNCHANGED, False: UPDATED})
        change.iloc[0] = NEW if first is None else UNCHANGED if first == hashes.iloc[0] else UPDATED
        self.last.update((hashes.iloc[-1],))
        yield part[self.columns].assign(_change=change)

    def close(self) -> None:
        pass


def stream_changes(
    items: DataFrame,
    seen: DataFrame | None = None,
    *,
    order: Sequence[str] = ("_scraped_at", "_content_hash"),
    brand: str = "brand",
    key: str = "_key",
    hash_col: str = "_content_hash",
) -> DataFrame:
    """The streaming rows of ``items`` with ``_change``.

    ``seen`` (brand, url, content_hash) is the state the first run starts from; later runs have
    their own. Items without a key are always new and keep no state. Bodies should have been left out.
    """
    ship_package(items.sparkSession)
    schema = T.StructType([*items.schema.fields, T.StructField("_change", T.StringType())])
    has_key = F.coalesce(F.col(key), F.lit("")) != ""
    initial = None
    if seen is not None:
        initial = seen.select(F.col("brand").alias(brand), F.col("url").alias(key), "content_hash").groupBy(brand, key)
    processor = _Changes(hash_col, order, items.columns)
    keyed = items.filter(has_key).groupBy(brand, key)
    changes = keyed.transformWithStateInPandas(processor, schema, "Append", "None", initialState=initial)
    return changes.unionByName(items.filter(~has_key).withColumn("_change", F.lit(NEW)))


def run_changes(items: DataFrame, path: str, seen: DataFrame | None = None, *, trigger: dict | None = None, **names) -> StreamingQuery:
    """Start the stream; changes are appended to ``path/changes``, progress and state lie in ``path/progress``.

    The session of ``items`` has to keep state in RocksDB (``state_session``).
    """
    writer = stream_changes(items, seen, **names).writeStream.format("parquet").outputMode("append")
    writer = writer.option("checkpointLocation", join_path(path, "progress")).option("path", join_path(path, "changes"))
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def state_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose streams keep their state in RocksDB."""
    own = spark.newSession()
    for name in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        own.conf.set(name, spark.conf.get(name))
    own.conf.set(STATE_STORE, ROCKSDB)
    return own
