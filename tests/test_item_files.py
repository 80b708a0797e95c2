"""One named file per item: all or nothing."""

from __future__ import annotations

import json
import os
from urllib.parse import unquote

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from folioflow.sources import item_files
from folioflow.sources.item_files import read_item_files, write_item_files

ITEM = "file_name string, title string, body string, tags array<string>"


def test_files_hold_their_items(spark, tmp_path):
    rows = [(f"b_article_{i}.json", f"t{i}", "ü\n" * i if i else None, ["x"] if i % 2 else None) for i in range(50)]
    path = str(tmp_path / "out")
    write_item_files(spark.createDataFrame(rows, ITEM).repartition(5), path)
    assert sorted(os.listdir(path)) == sorted(["_SUCCESS", *(r[0] for r in rows)])
    with open(os.path.join(path, "b_article_3.json"), encoding="utf-8") as f:
        assert json.load(f) == {"title": "t3", "body": "ü\nü\nü\n", "tags": ["x"]}
    back = read_item_files(spark, path, "title string, body string, tags array<string>")
    assert sorted(map(str, back.select("file_name", "title", "body", "tags").collect())) == sorted(
        map(str, spark.createDataFrame(rows, ITEM).collect())
    )
    # Another batch adds its files; the same one again changes nothing.
    write_item_files(spark.createDataFrame([("more.json", "m", None, None), rows[1]], ITEM), path)
    assert len(os.listdir(path)) == 52


@pytest.mark.parametrize("bad", [None, "a/b.json", ".hidden.json"])
def test_a_failed_write_leaves_no_file(spark, tmp_path, bad):
    path = str(tmp_path / "out")
    rows = spark.range(200).select(
        F.when(F.col("id") == 150, F.lit(bad)).otherwise(F.concat(F.lit("f"), "id", F.lit(".json"))).alias("file_name"), F.col("id").cast("string").alias("title")
    )
    with pytest.raises(Exception, match="no file can have the name"):
        write_item_files(rows.repartition(8), path)
    assert not os.path.exists(path) or os.listdir(path) == []


def test_tasks_that_outlive_a_failed_write_place_no_files(tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    batch = pa.RecordBatch.from_pydict({"file_name": [f"f{i}.json" for i in range(20)], "json": ["{}"] * 20})
    writer = item_files.ItemFiles({"path": path}).writer(None, False)
    names = item_files._names

    def failing(files, task):
        """The write fails while this task gives its files their names."""
        for n, name in enumerate(names(files, task)):
            if n == 7:
                monkeypatch.setattr(item_files, "_names", names)
                writer.abort([])
            yield name

    monkeypatch.setattr(item_files, "_names", failing)
    for _ in range(2):  # the second one only starts afterwards
        with pytest.raises(OSError):
            writer.write(iter([batch]))
    assert os.listdir(path) == []
    other = item_files.ItemFiles({"path": path}).writer(None, False)
    other.commit([other.write(iter([batch]))])
    assert len(os.listdir(path)) == 21


def test_reading_needs_no_task_per_few_files(spark, tmp_path):
    path = str(tmp_path / "out")
    write_item_files(spark.range(1500).select(F.concat(F.lit("f"), "id", F.lit(".json")).alias("file_name"), F.col("id").alias("n")), path)
    back = read_item_files(spark, path, "n long")
    assert back.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
    assert back.filter("file_name = concat('f', n, '.json')").agg(F.count("n"), F.sum("n")).first()[:] == (1500, 1500 * 1499 // 2)


def test_reading_odd_files_gives_the_rows_of_the_json_source_and_plain_names(spark, tmp_path):
    odd = {
        "a.json": b'{"title": "a", "n": 1, "tags": ["x", null]}',
        "two lines.json": b'{"title": "b"}\r\n\r\n  \n{"n": 2}\r{"title": "c"}\n',
        "list.json": b' [{"title": "d"}, {"n": 4}]',
        "none.json": b"[]",
        "empty.json": b"",
        "broken.json": b'{"title": "e", "n": 5\n[{"title": "f"\nword\n3',
        "wrong.json": b'{"title": {"x":1.5}, "n": "6", "tags": 7}',
        "number.json": b'{"title": 1.5, "n": 1.5, "tags": ["1", 2, {}]}',
        "bä%20.json": '\ufeff{"title": "\u00fc\u2028\u0085", "file_name": "mine"}'.encode(),
        ".hidden.json": b'{"n": 8}',
        "_hidden.json": b'{"n": 9}',
        "_brand=x.json": b'{"n": 10}',
        "a+ %.json": b'{"n": 13}',
        "other.txt": b'{"n": 11}',
        "upper.JSON": b'{"n": 12}',
    }
    for name, data in odd.items():
        (tmp_path / name).write_bytes(data)
    (tmp_path / "folder.json").mkdir()
    rows = lambda df: sorted(map(str, df.collect()))
    for fields in ("title string, n long, tags array<string>", "n int, FILE_NAME string, title string", "title string, _corrupt_record string"):
        want = spark.read.schema(fields).option("pathGlobFilter", "*.json").json(str(tmp_path))
        want = want.withColumn("file_name", F.col("_metadata.file_name"))
        got = read_item_files(spark, f"file://{tmp_path}", fields)
        assert got.schema == want.schema
        assert rows(got) == [unquote(r) for r in rows(want)]
    assert rows(read_item_files(spark, str(tmp_path / "[ab]*+ *.json"), "n int")) == ["Row(n=13, file_name='a+ %.json')"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_item_files(spark, str(tmp_path / "missing"), "n int")
