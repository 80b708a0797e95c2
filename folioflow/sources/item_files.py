"""Items as one named JSON file each, written by a data source with commit and abort.

A task writes its files to a folder of its own, then notes their names and moves them to their
place. Files are complete when they get their name, and a task that runs again puts the same
files in the same place. If the write fails as a whole, its working folder is moved away first, so
that tasks that still run can place no more files, and everything noted is removed again; when it
succeeds the working folder goes and ``_SUCCESS`` appears. The driver sees counts only.

Reading deals the names of a folder out by their hash: a task runs through the names, of which it
keeps none but its own, and reads those files. There is no list of all files on the driver and no
task for a handful of them, however many there are.

Paths may be local, ``file:`` or any address Arrow's file systems open.
"""

from __future__ import annotations

import contextlib
import os
import posixpath
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import ArrayType, StructType

from folioflow.session import ship_package

FORMAT = "item_files"
WORK, FAILED = "_writing", "_failed"
#: Lines and bytes after which a reading task hands on a batch.
BATCH_LINES, BATCH_BYTES = 512, 4 * 1024 * 1024


def _open(path: str) -> tuple[arrow_fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return arrow_fs.FileSystem.from_uri(path if "://" in path else "file://" + path[len("file:") :])
    return arrow_fs.LocalFileSystem(), path


@dataclass
class Written(WriterCommitMessage):
    files: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path, self.job = path, uuid.uuid4().hex
        files, root = _open(path)
        files.create_dir(self._top(root), recursive=True)

    def _top(self, root: str, kind: str = WORK) -> str:
        return posixpath.join(root, f"{kind}-{self.job}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, root = _open(self.path)
        # Not recursive: the folder of a write that has failed does not come again.
        mine = posixpath.join(self._top(root), uuid.uuid4().hex)
        files.create_dir(mine, recursive=False)
        files.create_dir(posixpath.join(mine, "files"), recursive=False)
        n = 0
        try:
            with files.open_output_stream(posixpath.join(mine, "names")) as names:
                for batch in iterator:
                    for name, text in zip(batch.column("file_name").to_pylist(), batch.column("json").to_pylist(), strict=True):
                        if not name or "/" in name or name[0] in "._":
                            raise ValueError(f"no file can have the name {name!r}")
                        with files.open_output_stream(posixpath.join(mine, "files", name)) as out:
                            out.write(text.encode())
                        names.write(name.encode() + b"\n")
                        n += 1
        except BaseException:
            with contextlib.suppress(OSError):  # gone when the write has failed elsewhere
                files.delete_dir(mine)
            raise
        for name in _names(files, mine):
            files.move(posixpath.join(mine, "files", name), posixpath.join(root, name))
        return Written(n)

    def commit(self, messages: list[Written | None]) -> None:
        files, root = _open(self.path)
        files.delete_dir(self._top(root))
        with files.open_output_stream(posixpath.join(root, "_SUCCESS")):
            pass

    def abort(self, messages: list[Written | None]) -> None:
        files, root = _open(self.path)
        top, gone = self._top(root), self._top(root, FAILED)
        try:
            files.move(top, gone)
        except (pa.ArrowException, OSError):  # an object store has no folders to move
            gone = top
        for task in files.get_file_info(arrow_fs.FileSelector(gone, allow_not_found=True)):
            for name in _names(files, task.path):
                here = posixpath.join(root, name)
                if files.get_file_info(here).type == arrow_fs.FileType.File:
                    files.delete_file(here)
        if files.get_file_info(gone).type == arrow_fs.FileType.Directory:
            files.delete_dir(gone)


def _names(files: arrow_fs.FileSystem, task: str) -> Iterator[str]:
    note = posixpath.join(task, "names")
    if files.get_file_info(note).type == arrow_fs.FileType.File:
        with files.open_input_stream(note) as text:
            yield from text.read().decode().splitlines()


class ItemFiles(DataSource):
    """``df(file_name, json).write.format("item_files")``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "file_name string, json string"

    def writer(self, schema, overwrite: bool) -> _Writer:
        if overwrite:
            raise ValueError("item files are added, never overwritten as a whole")
        return _Writer(self.options["path"])


def write_item_files(items: DataFrame, path: str) -> None:
    """Write each item of ``items`` to ``path/<file_name>``; null fields are left out."""
    spark = items.sparkSession
    ship_package(spark)
    spark.dataSource.register(ItemFiles)
    fields = [c for c in items.columns if c != "file_name"]
    rows = items.select("file_name", F.to_json(F.struct(*fields)).alias("json"))
    rows.write.format(FORMAT).mode("append").save(path)


def _listed(files: arrow_fs.FileSystem, root: str) -> Iterator[str]:
    """Names of the item files of a folder; those of a local one are never held all at once."""
    if isinstance(files, arrow_fs.LocalFileSystem):
        with os.scandir(root) as entries:
            names = (e.name for e in entries if e.name.endswith(".json") and e.is_file())
            yield from (n for n in names if _shown(n))
    else:
        found = files.get_file_info(arrow_fs.FileSelector(root))
        names = (f.base_name for f in found if f.type == arrow_fs.FileType.File and f.base_name.endswith(".json"))
        yield from (n for n in names if _shown(n))


def _shown(name: str) -> bool:
    return name[0] != "." and (name[0] != "_" or "=" in name)


def _lines_of(path: str, parts: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Lines of the files whose name's hash leaves the row's number when divided by ``parts``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _open(path)
        names, lines, size = [], [], 0
        for part in (n for batch in batches for n in batch.column(0).to_pylist()):
            for name in _listed(files, root):
                if zlib.crc32(name.encode()) % parts != part:
                    continue
                with files.open_input_stream(posixpath.join(root, name)) as file:
                    data = file.read()
                for line in data.decode("utf-8-sig", "replace").replace("\r", "\n").split("\n"):
                    if line and not line.isspace():
                        names.append(name)
                        lines.append(line)
                size += len(data)
                if len(lines) >= BATCH_LINES or size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(lines, pa.string())], ["_file", "_line"])
                    names, lines, size = [], [], 0
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(lines, pa.string())], ["_file", "_line"])

    return read


def read_item_files(spark, path: str, schema) -> DataFrame:
    """Items and the name of the file each came from: the ``*.json`` files of a folder, read when the rows are.

    Where a field that is to be text holds a fraction, an object or an array (``write_item_files`` writes
    none), it comes as JSON writes it anew: 1.50 as 1.5, no white space between parts.
    What Arrow cannot open, or is no folder (a pattern, say), is read by Spark's own source.
    """
    try:
        files, root = _open(path)
        folder = files.get_file_info(root).type == arrow_fs.FileType.Directory
    except (pa.ArrowException, OSError):
        folder = False
    if not folder:
        rows = spark.read.schema(schema).option("pathGlobFilter", "*.json").json(path)
        # Spark gives names as they are written in a URI.
        return rows.withColumn("file_name", F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))))
    ship_package(spark)
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    parts = 2 * spark.sparkContext.defaultParallelism
    lines = spark.range(0, parts, 1, parts).mapInArrow(_lines_of(path, parts), "_file string not null, _line string")
    # A line is an item, as a rule, or a list of items.
    many = F.when(F.ltrim("_line").startswith("["), F.from_json("_line", ArrayType(fields)))
    items = lines.select("_file", F.explode(F.coalesce(many, F.array(F.from_json("_line", fields)))).alias("_item"))
    return items.select("_item.*", "_file").withColumn("file_name", F.col("_file")).drop("_file")
