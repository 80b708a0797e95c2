"""URL filter: block and allow rules first, then logistic regression on hashed n-grams.

Everything is DataFrame functions: parsing, rule match and scoring are one projection with
the rules and the trained weights as literals; each training step is one aggregate over
the small labelled table, whose result has ``buckets`` numbers.

Defined results: a null url or one without ``://`` has empty host and path, fits no rule
and is scored by the intercept alone; repeated urls get equal verdicts; without labelled
urls of both verdicts everything that no rule decides gets ``default``. Input columns stay.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.llm.common import lower_ascii, whole
from folioflow.session import cut_lineage

#: (verdict, host, path prefix)
Rule = tuple[str, str, str]

BUCKETS, NGRAM, STEPS, RATE, RIDGE = 1024, 3, 16, 0.6, 1e-3
#: At most this many distinct labelled urls train the model; the smallest hashes are taken.
MAX_LABELLED = 2000
#: One in so many of them is of the rarer verdict at least, if there are as many.
RARE_SHARE = 10


def split_url(url: str | Column) -> tuple[Column, Column]:
    """Lower-cased host, and path, of a url."""
    at = F.locate("://", whole(url))
    rest = F.when(at > 0, F.substring(whole(url), at + 3, F.length(whole(url)))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return lower_ascii(host), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def match_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest fitting rule as a struct of its text and verdict, or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, name, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(prefix)
        hit = F.struct(F.lit(name + prefix).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, hit).otherwise(found)
    return found


def buckets_of(host: Column, path: Column, buckets: int = BUCKETS, n: int = NGRAM) -> Column:
    """Distinct hashed character n-grams of host and path; host and path each have a start mark."""
    text = F.concat(F.lit("^"), host, F.lit("|"), path)
    last = F.length(text) - F.lit(n - 1)
    starts = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    grams = F.transform(starts, lambda i: F.pmod(F.xxhash64(F.substring(text, i, F.lit(n))), F.lit(buckets)).cast("int"))
    return F.array_distinct(grams)


def probability(grams: str, weights: Sequence[float]) -> Column:
    """Probability of ``block``; ``weights`` ends with the intercept."""
    table = F.from_json(F.lit(json.dumps([round(w, 9) for w in weights])), "array<double>")
    total = F.aggregate(grams, F.lit(0.0), lambda a, g: a + F.get(table, g))
    scale = F.sqrt(F.greatest(F.size(grams), F.lit(1)).cast("double"))
    return 1 / (1 + F.exp(-(total / scale + F.lit(float(weights[-1])))))


def train(labelled: DataFrame, buckets: int = BUCKETS, steps: int = STEPS) -> list[float] | None:
    """Weights from ``labelled(grams, block)`` by AdaGrad on the full gradient of each step.

    None unless both verdicts occur. The loop moves ``buckets + 1`` sums per step.
    """
    rows = cut_lineage(labelled.select("grams", F.col("block").cast("double").alias("y")))
    n, positive = rows.agg(F.count("*"), F.sum("y")).first()
    if not n or positive in (0, n):
        return None
    weights, past = [0.0] * (buckets + 1), [1e-9] * (buckets + 1)
    weights[-1] = math.log(positive / (n - positive))
    scale = F.sqrt(F.greatest(F.size("grams"), F.lit(1)).cast("double"))
    for _ in range(steps):
        error = rows.select("grams", (probability("grams", weights) - F.col("y")).alias("e"), scale.alias("s"))
        terms = F.concat(
            F.transform("grams", lambda g: F.struct(g.alias("g"), (F.col("e") / F.col("s")).alias("d"))),
            F.array(F.struct(F.lit(buckets).alias("g"), F.col("e").alias("d"))),
        )
        sums = error.select(F.explode(terms).alias("t")).groupBy("t.g").agg(F.sum("t.d").alias("d")).collect()
        for g, d in sums:
            d = round(d / n, 12) + RIDGE * weights[g]
            past[g] += d * d
            weights[g] -= RATE * d / math.sqrt(past[g])
    return weights


def sample(seen: DataFrame, most: int) -> DataFrame:
    """``most`` distinct rows of ``seen(h, p, verdict)`` by hash, with a share of each verdict; repeats count once."""
    block = F.col("verdict") == "block"
    once = seen.filter("verdict is not null").select("h", "p", "verdict", block.alias("block")).distinct()
    order = [F.xxhash64("h", "p"), "h", "p", "verdict"]
    some = once.filter("block").orderBy(*order).limit(most).union(once.filter("not block").orderBy(*order).limit(most))
    place = F.row_number().over(Window.partitionBy("block").orderBy(*order))  # over 2 * most rows at most
    ranked = some.withColumn("place", place)
    share = max(1, most // RARE_SHARE)
    return ranked.orderBy(F.col("place") > share, *order).limit(most).drop("place")


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    labelled: DataFrame | None = None,
    url: str = "url",
    default: str = "allow",
    max_labelled: int = MAX_LABELLED,
) -> DataFrame:
    """Add ``host``, ``path``, ``rule``, ``verdict`` and ``block_probability`` to ``pages``.

    ``labelled(url, verdict)`` trains the model; without it, the urls that a rule decides do.
    """
    if labelled is None:
        host, path = split_url(url)
        seen = pages.select(host.alias("h"), path.alias("p"))
        seen = seen.withColumn("verdict", match_rule(F.col("h"), F.col("p"), rules)["verdict"])
    else:
        host, path = split_url("url")
        seen = labelled.select(host.alias("h"), path.alias("p"), "verdict")
    some = sample(seen, max_labelled)
    grams = buckets_of(F.col("h"), F.col("p"))
    weights = train(some.select(grams.alias("grams"), "block"))
    host, path = split_url(url)
    clash = {"host", "path", "rule", "verdict", "block_probability"}
    own = pages.select(*[f"`{c}`" for c in pages.columns if c not in clash], host.alias("host"), path.alias("path"))
    own = own.withColumn("_llm_rule", match_rule(F.col("host"), F.col("path"), rules))
    if weights is None:
        chance = F.lit(None).cast("double")
    else:
        own = own.withColumn("_llm_grams", buckets_of(F.col("host"), F.col("path")))
        chance = probability("_llm_grams", weights)
    own = own.withColumn("block_probability", chance)
    learned = F.when(F.col("block_probability") >= 0.5, "block").when(F.col("block_probability") < 0.5, "allow")
    return own.withColumns(
        {
            "rule": F.col("_llm_rule.rule"),
            "verdict": F.coalesce(F.col("_llm_rule.verdict"), learned, F.lit(default)),
        }
    ).drop("_llm_rule", "_llm_grams")
