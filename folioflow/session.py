"""Session set-up and the two places where physical layout is decided by hand."""

from __future__ import annotations

import contextlib
import os
import pathlib
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Settings every job of this library wants; a cluster may override any of them.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Of a key that a JSON object has twice the last value counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Pages are large rows: keep the Arrow batches of the DOM job small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
}

# Below this many bytes per core an input is too small to keep all cores busy.
SMALL_SPLIT_BYTES = 16 * 1024 * 1024

_SHIPPED: set[str] = set()
_LOCAL = threading.local()  # scopes of one thread never take in tables of another


def build_session(app: str = "folioflow", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    The Python stages import it there, wherever the driver was started from.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = pathlib.Path(__file__).resolve().parent
    archive = pathlib.Path(tempfile.mkdtemp(prefix="folioflow-code-")) / "folioflow-src.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    sc.addPyFile(str(archive))  # Spark serves the file to the executors
    _SHIPPED.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """Folder for written-out intermediate tables of this application.

    It lies in the shared folder the session names in ``spark.checkpoint.dir``. Only a
    local session without one gets a temporary folder.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="folioflow-checkpoint-")
        sc.setCheckpointDir(root)
    return join_path(root, f"folioflow-{sc.applicationId}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows of ``df`` from a table written to the shared folder.

    Unlike a checkpointed RDD the table is computed once, and its size is known to
    the optimizer afterwards.
    """
    path = join_path(shared_dir(df.sparkSession), uuid.uuid4().hex)
    df.write.parquet(path)
    for scope in _scopes():
        scope.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_counted(df: DataFrame) -> tuple[DataFrame, int]:
    """``cut_lineage`` and the number of rows, which the write itself counts."""
    seen = Observation()
    out = cut_lineage(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return out, seen.get["n"]


@contextlib.contextmanager
def passing_cuts(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside are deleted at the end: nothing read later may depend on them."""
    scope: list[str] = []
    _scopes().append(scope)
    try:
        yield
    finally:
        _scopes().pop()
        for path in scope:
            _delete(spark, path)


def _scopes() -> list[list[str]]:
    if not hasattr(_LOCAL, "scopes"):
        _LOCAL.scopes = []
    return _LOCAL.scopes


def drop_cuts(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application."""
    _delete(spark, shared_dir(spark))


def _delete(spark: SparkSession, path: str) -> None:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate; nothing is executed for it."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, max_rows: int = 10_000) -> DataFrame:
    """Broadcast hint for a configuration table, given only after its rows were counted.

    A bigger one is joined without a hint, so AQE decides.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def spread_small(df: DataFrame) -> DataFrame:
    """Give every core some rows of a small input before a Python stage.

    Big inputs are returned untouched: their splits already keep the cluster busy
    and page text must not cross the network for nothing.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if estimated_bytes(df) < cores * SMALL_SPLIT_BYTES else df


def join_path(root: str, *parts: str) -> str:
    return os.path.join(root, *parts) if "://" not in root else "/".join([root.rstrip("/"), *parts])
