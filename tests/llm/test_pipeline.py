"""Every stage of the pipeline on its own input, the whole run, and the driver contract."""

from __future__ import annotations

import os

import pytest
from llm.helpers import DOCS, broadcast_explodes, documents, texts

import __spark_entry__ as contract
import corpus_pipeline
from folioflow.llm import mixing, packing, simhash

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    values = texts(11, 60)
    values[10] = values[10] + " password=abcdef0123456789"
    values[11] = "A!! B!! C!! " * 40
    documents(spark, values).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, 0) for i in range(10)] + [(11, 0, 0)]
    spark.createDataFrame(labels, LABELS).write.parquet(f"{path}/labels.parquet")
    return path


def test_exploded_rows_are_not_broadcast(spark, folder, monkeypatch):
    docs, plans = spark.read.parquet(f"{folder}/documents.parquet"), []

    def seen(of):
        def run(df, *more):
            plans.append(broadcast_explodes(df))
            return of(df, *more)

        return run

    monkeypatch.setattr(simhash, "components", seen(simhash.components))
    assert corpus_pipeline.drop_copies(spark, docs, folder).count()
    plans.append(broadcast_explodes(mixing.plan_mix(docs)))
    assert plans == [[], []]


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        path = f"{folder}/stage{k}.parquet"
        out.write.mode("overwrite").parquet(path)
        out = spark.read.parquet(path)
        if k < 4:
            assert out.columns == docs.columns
        if k == 1:
            left = simhash.simhash_components(out).collect()
            assert len({r.component for r in left}) == len(left)
        if k == 2:
            assert out.count() == docs.count()
            (redacted,) = [r for r in out.collect() if r.doc_id == 10]
            assert "abcdef0123456789" not in redacted.text and redacted.n_chars == len(redacted.text)
        docs = out
    assert set(docs.columns) == {x.split()[0] for x in packing.SCHEMA.split(", ")}


def test_run(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    rows = out.select("doc_id", "start", "length", "sequence_id", "offset").collect()
    assert rows and all(r.length > 0 for r in rows)


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_contract():
    names = set(contract.queries())
    assert {f"op{n}" for n in range(1, 11)} <= {n.split("_")[0] for n in names} and "pipeline" in names
    assert set(contract.oracle_sql()) <= names
    assert corpus_pipeline.ORACLE_SQL is None


def test_nothing_else_needs_this_package():
    root = os.path.dirname(os.path.abspath(contract.__file__))
    for folder, _, files in os.walk(os.path.join(root, "folioflow")):
        if os.path.basename(folder) != "llm":
            for name in (f for f in files if f.endswith(".py")):
                with open(os.path.join(folder, name)) as f:
                    assert "folioflow.llm" not in f.read(), name
