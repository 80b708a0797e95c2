"""Small inputs that hold the awkward cases, and helpers for brute-force comparisons."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and in to ing ther ation house tree river stone light paper green water north clock".split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ed", ","]) for _ in range(n))


def texts(seed: int = 1, n: int = 60) -> list[str | None]:
    """Plain texts, copies, near copies, empty, null, white space only, one word, and a very long one."""
    rng = random.Random(seed)
    plain = [sentence(rng, rng.randint(3, 120)) for _ in range(n)]
    near = [t + " end" for t in plain[:5]]
    long = sentence(rng, 30_000)
    return [*plain, *plain[:6], *near, None, None, "", "", " \n\t ", "word", "Ünïcode ÄÖ  x", long, "y" * 5000, "a b c " * 300]


def documents(spark, values: list[str | None], extra: bool = False):
    """Rows with ids in order, nulls in every column, one repeated row; ``extra`` adds clashing names."""
    rows = [(i, t, "en", f"src{i % 4}", len(t or "")) for i, t in enumerate(values)]
    rows += [(None, "text without id", None, None, None), (None, None, None, None, None), rows[0], rows[0]]
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        from pyspark.sql import functions as F

        for name in ("size", "id", "fp", "component", "count", "k1", "score", "x", "a.b", "units", "key", "spans"):
            df = df.withColumn(name, F.lit(name))
    return df.repartition(3)


def broadcast_explodes(df) -> list[str]:
    """Explodes of the plan that a broadcast takes without a shuffle between, after which sizes are known."""
    found, above = [], []
    for line in df._jdf.queryExecution().executedPlan().toString().split("\n"):
        name = line.lstrip(" :+-*")
        deep = len(line) - len(name)
        above = [x for x in above if x[0] < deep]
        if name.startswith(("Exchange", "BroadcastExchange")):
            above.append((deep, name.startswith("BroadcastExchange")))
        elif name.startswith("Generate explode") and above and above[-1][1]:
            found.append(line)
    return found
