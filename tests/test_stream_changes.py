"""The stateful stream of changes against the batch form."""

from __future__ import annotations

import random

from folioflow.operators.quality import detect_changes
from folioflow.streaming.changes import run_changes, state_session

ITEM = "_n long, brand string, _key string, _content_hash string"
SEEN = "brand string, url string, content_hash string"


def test_stream_equals_batch_over_restarts(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, rng.choice("ab"), rng.choice([None, "", "k1", "k2", "k3"]), f"h{rng.randint(0, 1)}") for i in range(400)]
    seen = spark.createDataFrame([("a", "k1", "h0"), ("b", "k2", "h1"), ("b", "other", "h0")], SEEN)
    own, landing = state_session(spark), str(tmp_path / "landing")
    started = own.createDataFrame(seen.collect(), SEEN)
    for n in range(4):  # the last run finds nothing new
        part = rows[n * 150 : (n + 1) * 150]
        if part:
            spark.createDataFrame(part, ITEM).repartition(3).write.mode("append").parquet(landing)
        arriving = own.readStream.schema(ITEM).parquet(landing)
        query = run_changes(arriving, str(tmp_path / "out"), started, order=("_n",))
        query.awaitTermination()
    got = {r._n: (r.brand, r._key, r._content_hash, r._change) for r in spark.read.parquet(str(tmp_path / "out" / "changes")).collect()}
    want = detect_changes(spark.createDataFrame(rows, ITEM), seen, order=("_n",)).collect()
    assert got == {r._n: (r.brand, r._key, r._content_hash, r._change) for r in want} and len(got) == 400
    assert {c for *_, c in got.values()} == {"new", "updated", "unchanged"}
