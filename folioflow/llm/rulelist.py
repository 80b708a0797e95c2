"""Quality rules: text statistics, and a decision list learned from labelled statistics.

Statistics are built-in functions inside the row, so a text never leaves its partition.
Sequential covering grows one rule at a time: each step adds the threshold with the best
information gain over the labelled rows that no earlier rule covers, counted by one
aggregate per step; the rule is then pruned on held-back rows. The list is emitted as
ordered conditional expressions.

Defined results: a null or empty text has zero in every statistic and fails the base rule;
unlabelled rows train nothing; a doc_id that is labelled more than once counts with its
lowest label; without labels, or with one class only, the list is empty and keeps what the
base rule keeps; repeated rows get equal results; extra columns are carried along.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import WORD, crc_fold, whole
from folioflow.session import cut_lineage

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
CUTS, MAX_RULES, MAX_CONDITIONS, MIN_PRECISION, MIN_COVER = 24, 6, 3, 0.7, 3
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("n_words", "mean_word", "symbol_share", "dup_lines_per_100_words", "repeat_share")


def text_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without ``text`` and with the five statistics."""
    rest = [f"`{c}`" for c in docs.columns if c != text and c not in STATS]
    body = whole(text)
    base = docs.select(*rest, body.alias("_llm_t"), F.regexp_extract_all(body, F.lit(WORD), F.lit(0)).alias("_llm_w"))
    w, t = F.col("_llm_w"), F.col("_llm_t")
    starts = F.when(F.size(w) >= 3, F.sequence(F.lit(0), F.size(w) - 3)).otherwise(F.array().cast("array<int>"))
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD))
    base = base.select(
        *rest,
        F.size(w).cast("long").alias("n_words"),
        F.length(F.translate(t, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("_llm_l"),
        F.transform(starts, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))).alias("_llm_g"),
    )
    g, lines = F.col("_llm_g"), F.col("_llm_l")
    # Windows found twice stand beside each other in hash order. Most texts repeat none: they skip the sort.
    ordered = F.when(
        F.size(F.array_distinct(g)) < F.size(g),
        F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    base = base.select(
        *rest, *STATS[:3], (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"), ordered.alias("_llm_s")
    )
    s = F.col("_llm_s")
    same = lambda x, j: x["h"] == F.get(s, j)["h"]
    twice = F.filter(s, lambda x, j: F.coalesce(F.when(j > 0, same(x, j - 1)), F.lit(False)) | F.coalesce(same(x, j + 1), F.lit(False)))
    base = base.withColumn("_llm_p", F.sort_array(F.transform(twice, lambda x: x["i"])))
    p = F.col("_llm_p")
    # A window covers three words, or fewer when the next one starts inside it.
    steps = F.zip_with(p, F.slice(p, F.lit(2), F.size(p)), lambda a, b: F.coalesce(F.least(F.lit(3), b - a), F.lit(3)))
    covered = F.when(F.size(p) > 0, F.aggregate(steps, F.lit(0), lambda a, x: a + x)).otherwise(F.lit(0))
    return base.select(*rest, *STATS[:4], covered.cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def feature(name: str) -> Column:
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "n_words": F.col("n_words").cast("double"),
        "mean_word": F.col("word_chars") / n,
        "symbol_share": F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1)).cast("double"),
        "dup_lines_per_100_words": 100 * F.col("n_dup_lines") / n,
        "repeat_share": F.col("n_repeat_words") / n,
    }[name]


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    cut: float

    def column(self) -> Column:
        return feature(self.name) > self.cut if self.above else feature(self.name) <= self.cut

    def __str__(self) -> str:
        return f"{self.name} {'>' if self.above else '<='} {self.cut:g}"


Rule = tuple[Condition, ...]


def all_of(rule: Rule) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column()
    return out


def _entropy_gain(p: float, n: float, p0: float, n0: float) -> float:
    """Gain in bits of the rejected rows that stay covered."""
    from math import log2

    return p * (log2(p / (p + n)) - log2(p0 / (p0 + n0))) if p else 0.0


def learn_rules(labelled: DataFrame, doc_id: str = "doc_id", label: str = "quality") -> list[Rule]:
    """Ordered rules for label 0 from ``labelled`` (statistics, id and label)."""
    rows = labelled.select(
        *STATS, (F.col(label) == 0).cast("long").alias("bad"), (crc_fold(doc_id, 3) == 0).alias("held")
    )
    rows = cut_lineage(rows)
    levels = [i / CUTS for i in range(CUTS + 1)]
    asked = [F.percentile_approx(feature(f), levels, 1000).alias(f) for f in FEATURES]
    n, bad, *cuts = rows.agg(F.count("*"), F.sum("bad"), *asked).first()
    if not n or bad in (0, n):
        return []
    cuts = {f: sorted(set(c)) for f, c in zip(FEATURES, cuts, strict=True)}
    # Bin j of a feature holds the values above j of its cuts.
    bins = F.array(
        *[
            F.struct(F.lit(k).alias("f"), sum(((feature(f) > c).cast("int") for c in cuts[f]), F.lit(0)).alias("bin"))
            for k, f in enumerate(FEATURES)
        ]
    )
    binned = cut_lineage(rows.withColumn("bins", bins))
    rules: list[Rule] = []
    while len(rules) < MAX_RULES:
        free = binned
        for r in rules:
            free = free.filter(~all_of(r))
        rule: Rule = ()
        while len(rule) < MAX_CONDITIONS:
            counted = (
                free.filter(~F.col("held") & all_of(rule))
                .select("bad", F.explode("bins").alias("b"))
                .groupBy("b.f", "b.bin")
                .agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n"))
                .collect()
            )
            best = _best_condition(counted, cuts)
            if best is None:
                break
            rule, done = (*rule, best[0]), best[1]
            if done:
                break
        rule = _pruned(free, rule)
        if not rule:
            break
        rules.append(rule)
    return rules


def _best_condition(counted, cuts) -> tuple[Condition, bool] | None:
    """The threshold with the highest gain, and whether it leaves no good row covered."""
    best, top = None, 1e-9
    for k, name in enumerate(FEATURES):
        cells = {r["bin"]: (r["p"], r["n"]) for r in counted if r["f"] == k}
        p0, n0 = (sum(v[i] for v in cells.values()) for i in (0, 1))
        if not p0 or not n0:
            return best
        for j, cut in enumerate(cuts[name]):
            below = [sum(v[i] for b, v in cells.items() if b <= j) for i in (0, 1)]
            for above, (p, n) in ((False, below), (True, (p0 - below[0], n0 - below[1]))):
                gain = _entropy_gain(p, n, p0, n0) if p >= MIN_COVER else 0.0
                if gain > top:
                    best, top = (Condition(name, above, cut), n == 0), gain
    return best


def _pruned(free: DataFrame, rule: Rule) -> Rule:
    """The prefix of the rule that is worth most on the held-back rows, or nothing."""
    if not rule:
        return ()
    asked = []
    for k in range(1, len(rule) + 1):
        hit = all_of(rule[:k])
        asked += [F.count_if(hit & (F.col("bad") == 1)), F.count_if(hit & (F.col("bad") == 0))]
    found = free.filter("held").agg(*asked).first()
    worth = [((p - n) / (p + n) if p + n else -1.0, -k, p) for k, (p, n) in enumerate(zip(found[::2], found[1::2], strict=True), 1)]
    value, k, p = max(worth)
    return rule[:-k] if value >= 2 * MIN_PRECISION - 1 and p >= MIN_COVER else ()


def verdict(rules: list[Rule]) -> Column:
    """``reject`` from the first rule that holds, else ``keep``."""
    out = None
    for r in rules:
        out = F.when(all_of(r), "reject") if out is None else out.when(all_of(r), "reject")
    return F.lit("keep") if out is None else out.otherwise("keep")


def judge_quality(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Statistics of every text with ``base_failed`` and ``kept``, one pass over the texts."""
    stats = cut_lineage(text_stats(docs, text))
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = known.select(F.col("doc_id").alias("_llm_id"), F.col("quality").alias("_llm_y"))
    labelled = stats.select(doc_id, *STATS).join(known, F.col(doc_id) == F.col("_llm_id"))
    rules = learn_rules(labelled, doc_id, "_llm_y")
    out = stats.withColumn("base_failed", base_failed())
    return out.withColumn("kept", ~F.col("base_failed") & (verdict(rules) == "keep"))
