"""Versioned tables for what has to survive runs, stored by version and key bucket.

Every batch adds one small delta; a base gathers all of them from time to time.
Batch N only ever reads versions below N and writes version N, so running a batch
again reads the same input and puts the same result in the same place.

Inside a version rows lie in folders by the hash of their key. A batch that names its keys
reads only the buckets these fall into: the few bucket numbers are joined with the folder
column, which prunes the scan while it runs. The number of buckets is part of the path, so
a table keeps the one it was made with.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow import schemas
from folioflow.operators.quality import merge_intervals, number_intervals, parse_file_names
from folioflow.session import join_path

COMPACT_EVERY = 20
MIN_BUCKETS, MAX_BUCKETS = 4, 4096
BUCKET = "_bucket"


def folders(spark: SparkSession, root: str) -> list[str]:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(conf)
    return [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()] if fs.exists(path) else []


def complete_dirs(spark: SparkSession, root: str) -> list[str]:
    """Names of the folders under ``root`` whose write has finished."""
    names = folders(spark, root)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    return [n for n in names if fs.exists(path(join_path(root, n, "_SUCCESS")))]


def stored_buckets(spark: SparkSession, root: str, wanted: int | None = None) -> int:
    """Number of buckets of the table below ``root``.

    Of a table that is not there yet: ``wanted``, or the session's shuffle partitions within bounds.
    """
    found = [int(n[8:]) for n in folders(spark, root) if re.fullmatch(r"buckets=\d+", n)]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(found, default=wanted or max(MIN_BUCKETS, min(MAX_BUCKETS, tasks)))


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def touched_buckets(keys: DataFrame, names: Sequence[str], buckets: int) -> DataFrame:
    """The buckets that ``keys`` fall into: ``buckets`` rows at most, whatever the keys."""
    # The comparison holds for every row; it tells the optimizer that pruning by this side pays.
    return keys.select(bucket_of(names, buckets).alias(BUCKET)).distinct().filter(F.col(BUCKET) >= 0)


def write_buckets(rows: DataFrame, path: str, mode: str = "overwrite", **options: str) -> None:
    """Write by the folder column ``_bucket``, a bucket in as many tasks as its size asks for."""
    rows.hint("rebalance", BUCKET).write.mode(mode).options(**options).partitionBy(BUCKET).parquet(path)


class VersionedTable:
    """``delta/run=N`` and ``base/run=N`` under one root, cut into buckets of ``keys``."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], buckets: int | None = None):
        self.spark, self.schema, self.keys = spark, schema, list(keys)
        self.buckets = stored_buckets(spark, root, buckets)
        self.root = join_path(root, f"buckets={self.buckets}")

    def _versions(self, kind: str, below: int) -> list[int]:
        found = (re.fullmatch(r"run=(\d+)", n) for n in complete_dirs(self.spark, join_path(self.root, kind)))
        return sorted(v for m in found if m and (v := int(m.group(1))) < below)

    def _read(self, kind: str, versions: Sequence[int], touched: DataFrame | None) -> DataFrame:
        top = join_path(self.root, kind)
        schema = T.StructType([*self.schema.fields, T.StructField("run", T.LongType()), T.StructField(BUCKET, T.IntegerType())])
        paths = [join_path(top, f"run={v}") for v in versions]
        rows = self.spark.read.schema(schema).option("basePath", top).parquet(*paths)
        if touched is not None:
            rows = rows.join(F.broadcast(touched), BUCKET, "left_semi")
        return rows.select(*self.schema.names, F.col("run").alias("_run"))

    def read_before(self, version: int, keys: DataFrame | None = None) -> DataFrame:
        """All rows below ``version`` with ``_run``, the version they came with.

        With ``keys`` only the rows of these, from their buckets alone.
        """
        touched = None if keys is None else touched_buckets(keys, self.keys, self.buckets)
        bases = self._versions("base", version)[-1:]
        deltas = [v for v in self._versions("delta", version) if not bases or v > bases[0]]
        parts = [self._read(kind, found, touched) for kind, found in (("base", bases), ("delta", deltas)) if found]
        if not parts:
            return self.spark.createDataFrame([], self.schema).withColumn("_run", F.lit(-1).cast("long"))
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return rows if keys is None else rows.join(keys.select(*self.keys).distinct(), self.keys, "left_semi")

    def _write(self, kind: str, rows: DataFrame, version: int) -> None:
        marked = rows.select(*self.schema.names, bucket_of(self.keys, self.buckets).alias(BUCKET))
        write_buckets(marked, join_path(self.root, kind, f"run={version}"))

    def write_delta(self, rows: DataFrame, version: int) -> None:
        self._write("delta", rows, version)

    def gathered(self, rows: DataFrame) -> DataFrame:
        """What a base keeps of all rows."""
        return rows.drop("_run")

    def compact(self, version: int) -> None:
        """Gather everything up to and including ``version`` into one base."""
        self._write("base", self.gathered(self.read_before(version + 1)), version)


class SeenTable(VersionedTable):
    """Last content hash per (brand, url)."""

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        super().__init__(spark, root, schemas.SEEN, ["brand", "url"], buckets)

    def gathered(self, rows: DataFrame) -> DataFrame:
        last = rows.groupBy("brand", "url").agg(F.max_by(F.struct("content_hash", "seen_at"), "_run").alias("_last"))
        return last.select("brand", "url", "_last.content_hash", "_last.seen_at")

    def before(self, version: int, keys: DataFrame | None = None) -> DataFrame:
        """State as batch ``version`` has to see it, for ``keys`` (brand, url) only if given."""
        return self.gathered(self.read_before(version, keys))


class NameTable(VersionedTable):
    """Output names already used, as intervals of numbers per base name: no row per name."""

    SCHEMA = T.StructType(
        [T.StructField("_base", T.StringType()), T.StructField("_lo", T.LongType()), T.StructField("_hi", T.LongType())]
    )

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        super().__init__(spark, root, self.SCHEMA, ["_base"], buckets)

    def write_names(self, names: DataFrame, version: int) -> None:
        """Keep the ``file_name`` of a batch."""
        self.write_delta(number_intervals(parse_file_names(names)), version)

    def gathered(self, rows: DataFrame) -> DataFrame:
        return merge_intervals(rows.drop("_run"))

    def before(self, version: int, keys: DataFrame | None = None) -> DataFrame:
        """Intervals of used numbers, for base names ``keys(_base)`` only if given; they may touch each other."""
        return self.read_before(version, keys).drop("_run")
