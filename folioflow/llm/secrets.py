"""Secret scans: fixed patterns, and a battery of randomness tests on other long tokens.

Patterns give the base spans. Any other run of ``[A-Za-z0-9+/_=-]`` of 20 characters or
more is a candidate. Its encoding is inferred from its characters, and three statistics are
taken of it: chi-squared of its symbols over that alphabet, runs (how often words, capitals
and digits take turns), and the serial dependence of neighbouring letters. Each gives

* a p-value under plain text, as the corpus itself has it (``learn_text``: how often each
  symbol and each pair of letters stands in its words): chi-squared too small for text, too
  many runs, neighbours that text does not put together;
* a z value under a random token of that alphabet, where runs and correlation are those of
  the symbols' places in the alphabet.

The p-values are combined by Fisher's method. A candidate is a secret if the combined one
passes the false-discovery control over all candidates of the corpus, where a candidate's
share of the error grows with its length, and no z value contradicts randomness. The control
needs only counts per p-value step, so the corpus gives one threshold, and marking is local
to the row. Digits alone are as uniform in text as in a key: they give no evidence.

Defined results: null and empty texts have no spans; repeated rows get equal results;
positions are code points, end exclusive; extra columns are kept; an empty table gives an
empty result and the threshold that lets nothing pass. A corpus without words gives a model
in which all symbols are equally usual.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import whole

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = ("assign", "access", "hex")
#: Maximal runs: asking for the least length in the pattern gives the same matches as dropping shorter ones.
ACCESS, HEX = r"AKIA[A-Z0-9]{14,}", r"[0-9a-f]{16,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Words that teach what text is: too short for a candidate, and no part of a longer run.
WORD = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9]{2,19}(?![A-Za-z0-9+/_=-])"
DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Usual encodings, by what a token has to look like; the first that fits is inferred.
ALPHABETS = (
    ("^[0-9]+$", DIGITS),
    ("^[0-9a-f]+$", DIGITS + "abcdef"),
    ("^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("^[a-z]+$", LOWER),
    ("^[A-Z]+$", UPPER),
    ("^[A-Z2-7]+=*$", UPPER + "234567"),
    ("^[0-9a-z]+$", DIGITS + LOWER),
    ("^[0-9A-Z]+$", DIGITS + UPPER),
    ("^[A-Za-z]+$", UPPER + LOWER),
    ("^(?=.*[_-])[A-Za-z0-9_-]+=*$", UPPER + LOWER + DIGITS + "-_"),
    ("^[A-Za-z0-9]+$", UPPER + LOWER + DIGITS),
    ("", UPPER + LOWER + DIGITS + "+/"),
)
#: Share of letter pairs of text that are taken as independent, so that an unseen pair is no proof.
LOOSE = 0.3
#: Rate of class changes in plain text, error share, and the mean length that gets that share.
CHANGE_RATE, FDR, MEAN_LENGTH = 0.08, 0.001, 32
#: The battery rejects randomness above this z (about 1 in 10,000).
MAX_Z = 3.8
CHUNK = 2048  # code points
STEPS = 400  # p-values are counted in steps of a tenth of a power of ten
SPANS = "array<struct<start:int,kind:int,end:int,name:string>>"


def _none() -> Column:
    return F.array().cast(SPANS)


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, also where ``use`` has it inside a loop."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(values: Column, add: Callable[[Column, Column], Column]) -> Column:
    """Running totals of an array under ``add``: a scan by doubling steps, n log n in all."""

    def step(acc: Column, k: Column) -> Column:
        back = F.call_function("shiftleft", F.lit(1), k)
        return F.transform(acc, lambda x, i: F.when(i < back, x).otherwise(add(x, F.get(acc, i - back))))

    rounds = lambda v: F.filter(F.sequence(F.lit(0), F.lit(30)), lambda k: F.call_function("shiftleft", F.lit(1), k) < F.size(v))
    return _bind(values, lambda v: F.aggregate(rounds(v), v, step))


def _matches(text: Column, pattern: str) -> Column:
    """All matches as ``start, end, token``: lengths of what lies between the matches give the positions."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.zip_with(
        found,
        F.split(text, pattern, -1),
        lambda m, gap: F.struct((F.length(gap) + F.length(m)).alias("step"), m.alias("token")),
    )
    parts = F.filter(parts, lambda x: x["token"].isNotNull())

    def place(x: Column, end: Column) -> Column:
        return F.struct((end - F.length(x["token"])).alias("start"), end.alias("end"), x["token"].alias("token"))

    return _bind(parts, lambda p: F.zip_with(p, _running(p.getField("step"), lambda a, b: a + b), place))


def _as_span(x: Column, kind: int, name: str) -> Column:
    return F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end"), F.lit(name).alias("name"))


def _spans(text: Column, pattern: str, kind: int, name: str, fits: Callable[[Column], Column] | None = None) -> Column:
    """Spans of the matches, or of those whose token ``fits``."""
    found = _matches(text, pattern)
    if fits is not None:
        found = F.filter(found, lambda x: fits(x["token"]))
    return F.when(text.rlike(pattern), F.transform(found, lambda x: _as_span(x, kind, name))).otherwise(_none())


def base_spans(text: Column) -> tuple[Column, Column, Column]:
    """Spans of the three base kinds, each by position."""
    long = lambda token: F.length(F.regexp_extract(token, ASSIGN, 2)) >= 12
    assign = _spans(text, ASSIGN, 0, "assign", long)
    return assign, _spans(text, ACCESS, 1, "access"), _spans(text, HEX, 2, "hex")


def _by_alphabet(token: Column, value: Callable[[str], Column]) -> Column:
    """``value`` of the smallest usual alphabet that holds all characters: the inferred encoding."""
    (first, letters), *more = ALPHABETS
    out = F.when(token.rlike(first), value(letters))
    for pattern, letters in more[:-1]:
        out = out.when(token.rlike(pattern), value(letters))
    return out.otherwise(value(more[-1][1]))


class TextModel(NamedTuple):
    """What plain text is like: shares of symbols, and for letters ``log(p(b after a) / p(b))``."""

    shares: dict[str, float]
    pairs: list[float]

    def unevenness(self, letters: str) -> float:
        """Chi-squared that text has over an alphabet, beyond its freedom, per symbol.

        Where an alphabet has one case only, letters of both count: capitals spell the same words.
        """
        one = not set(LOWER) & set(letters) or not set(UPPER) & set(letters)
        have = [sum(self.shares.get(x, 0.0) for x in ({c.lower(), c.upper()} if one else {c})) for c in letters]
        return max(0.0, len(letters) * sum(p * p for p in have) / sum(have) ** 2 - 1) if sum(have) else 0.0


def learn_text(docs: DataFrame, text: str = "text") -> TextModel:
    """Counts of symbols and letter pairs over the words of all texts: at most 62 and 676 rows come to the driver.

    Words are counted first, each partition for itself, so that a usual word costs one row.
    """
    words = docs.select(F.explode(F.regexp_extract_all(whole(text), F.lit(WORD), F.lit(0))).alias("w")).groupBy("w").count()
    w, low = F.col("w"), F.lower("w")
    single = F.transform(F.split(w, ""), lambda c: F.struct(F.lit(1).alias("n"), c.alias("gram")))
    places = F.sequence(F.lit(1), F.length(w) - 1)
    double = F.filter(F.transform(places, lambda i: F.substring(low, i, F.lit(2))), lambda g: g.rlike("^[a-z]{2}$"))
    grams = F.concat(single, F.transform(double, lambda g: F.struct(F.lit(2).alias("n"), g.alias("gram"))))
    rows = words.select("count", F.explode(grams).alias("g")).groupBy("g.n", "g.gram").agg(F.sum("count").alias("c")).collect()
    return text_model({r["gram"]: r["c"] for r in rows})


def text_model(counts: dict[str, int]) -> TextModel:
    """The model of counted symbols (one character) and lower-case letter pairs (two)."""
    symbols = UPPER + LOWER + DIGITS
    total = sum(counts.get(c, 0) + 1 for c in symbols)
    shares = {c: (counts.get(c, 0) + 1) / total for c in symbols}
    after = {b: 1 + sum(counts.get(a + b, 0) for a in LOWER) for b in LOWER}
    n, pairs = sum(after.values()), []
    for a in LOWER:
        before = sum(counts.get(a + b, 0) for b in LOWER)
        for b in LOWER:
            alone = after[b] / n
            # Pseudo-counts: a letter seen a few times says little about what follows it.
            seen = (counts.get(a + b, 0) + 26 * alone) / (before + 26)
            pairs.append(math.log(LOOSE + (1 - LOOSE) * seen / alone))
    return TextModel(shares, pairs)


def _body(token: Column) -> Column:
    return F.regexp_replace(token, "[=]+$", "")


def _chi(body: Column, letters: Column) -> Column:
    """Chi-squared of the symbols against equal use of the alphabet."""
    n = F.length(body).cast("double")
    squares = F.transform(F.split(letters, ""), lambda c: F.pow(n - F.length(F.replace(body, c, F.lit(""))), F.lit(2.0)))
    return F.aggregate(squares, F.lit(0.0), lambda a, x: a + x) * F.length(letters) / F.greatest(n, F.lit(1.0)) - n


def uniform_p_value(token: Column, model: TextModel) -> Column:
    """Minus log10 of the p-value under text of a chi-squared as small as this.

    Text has a noncentral chi-squared, whose cube root is nearly normal; the tail is bounded by exp(-z^2 / 2).
    """

    def of(ctx: Column) -> Column:
        chi = F.greatest(_chi(ctx["body"], ctx["letters"]), F.lit(0.0))
        free = F.length(ctx["letters"]) - 1.0
        extra = F.greatest(F.length(ctx["body"]) - 1, F.lit(0)) * ctx["uneven"]
        spread = 2 * (free + 2 * extra) / (9 * (free + extra) * (free + extra))
        z = (1 - spread - F.pow(chi / (free + extra), F.lit(1 / 3))) / F.sqrt(spread)
        return F.when(z > 0, z * z / (2 * math.log(10))).otherwise(0.0)

    def seen(letters: str) -> Column:
        return F.struct(F.lit(letters).alias("letters"), F.lit(model.unevenness(letters)).alias("uneven"))

    kind = _by_alphabet(token, seen)
    return _bind(F.struct(_body(token).alias("body"), kind["letters"].alias("letters"), kind["uneven"].alias("uneven")), of)


def serial_p_value(token: Column, model: TextModel) -> Column:
    """Minus log10 of the p-value under text of neighbours that depend as little on each other as these.

    The product of ``p(b) / p(b after a)`` is 1 in the mean of text, so by Markov's inequality its inverse bounds the p-value.
    """
    table = F.lit(model.pairs)
    place = lambda c: F.ascii(c) - ord("a")

    def of(letters: Column) -> Column:
        n = F.size(letters)
        both = F.zip_with(
            F.slice(letters, F.lit(1), n - 1),
            F.slice(letters, F.lit(2), n),
            lambda a, b: F.when(a.between("a", "z") & b.between("a", "z"), F.get(table, 26 * place(a) + place(b))).otherwise(0.0),
        )
        return F.greatest(F.lit(0.0), -F.aggregate(both, F.lit(0.0), lambda s, x: s + x) / math.log(10))

    return _bind(F.split(F.lower(token), ""), of)


def runs_p_value(token: Column) -> Column:
    """Minus log10 of the p-value of the runs of words, capitals and digits under plain text; 0 if there are no more than usual."""
    plain = F.regexp_replace(token, "[^A-Za-z0-9]+", "")
    n = F.greatest(F.length(plain) - 1, F.lit(1))
    # A word is one mark, a capital before it included; borders between unlike marks are counted.
    words = F.regexp_replace(F.regexp_replace(plain, "[A-Z]?[a-z]+", "a"), "a+", "a")
    shape = F.regexp_replace(F.regexp_replace(words, "[A-Z]+", "B"), "[0-9]+", "0")
    rate = F.greatest(F.lit(0.0), F.least(F.lit(0.999), (F.length(shape) - 1) / n))
    q = F.lit(CHANGE_RATE)
    divergence = rate * F.log(rate / q) + (1 - rate) * F.log((1 - rate) / (1 - q))
    return F.when(rate > q, n * divergence / F.log(F.lit(10.0))).otherwise(0.0)


def combined_p_value(token: Column, model: TextModel) -> Column:
    """Minus log10 of Fisher's combination of the three p-values (chi-squared with six degrees of freedom)."""
    log = math.log(10)
    parts = uniform_p_value(token, model) + runs_p_value(token) + serial_p_value(token, model)
    return _bind(parts, lambda e: e - F.log10(1 + e * log + e * log * e * log / 2))


def battery(token: Column) -> Column:
    """Largest z of the chi-squared, runs and serial-correlation tests against a random token."""
    def of(ctx):
        body, letters = ctx["body"], ctx["letters"]
        n, k = F.length(body).cast("double"), F.length(letters).cast("double")
        chi = _chi(body, letters)
        # Wilson and Hilferty: the cube root of chi-squared over its freedom is nearly normal.
        free = k - 1
        z_chi = (F.pow(F.greatest(chi, F.lit(0.0)) / free, F.lit(1 / 3)) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
        at = F.transform(F.split(body, ""), lambda c: F.call_function("locate", c, letters).cast("double"))
        return F.struct(z_chi.alias("chi"), at.alias("at"), n.alias("n"), k.alias("k"))

    def finish(s):
        n, at, k = s["n"], s["at"], s["k"]
        mid, mean = (k + 1) / 2, s["mean"]
        pairs = s["pairs"]
        high = F.aggregate(at, F.lit(0.0), lambda a, x: a + F.when(x > mid, 1.0).otherwise(0.0))
        runs = 1 + F.aggregate(pairs, F.lit(0.0), lambda a, x: a + F.when((x["a"] > mid) != (x["b"] > mid), 1.0).otherwise(0.0))
        both = 2 * high * (n - high)
        spread = F.greatest(both * (both - n) / (n * n * (n - 1)), F.lit(1e-9))
        z_runs = F.abs(runs - (both / n + 1)) / F.sqrt(spread)
        var = F.aggregate(at, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean))
        serial = F.aggregate(pairs, F.lit(0.0), lambda a, x: a + (x["a"] - mean) * (x["b"] - mean)) / F.greatest(var, F.lit(1e-9))
        z_serial = F.abs(serial + 1 / n) * F.sqrt(n)
        return F.greatest(s["chi"], z_runs, z_serial)

    def centre(s):
        mean = F.aggregate(s["at"], F.lit(0.0), lambda a, x: a + x) / s["n"]
        pairs = F.zip_with(
            F.slice(s["at"], F.lit(1), s["n"].cast("int") - 1),
            F.slice(s["at"], F.lit(2), s["n"].cast("int")),
            lambda a, b: F.struct(a.alias("a"), b.alias("b")),
        )
        return F.struct(s["chi"], s["at"], s["n"], s["k"], mean.alias("mean"), pairs.alias("pairs"))

    ctx = F.struct(_body(token).alias("body"), _by_alphabet(token, F.lit).alias("letters"))
    return _bind(_bind(_bind(ctx, of), centre), finish)


def _weighted(p: Column, token: Column) -> Column:
    """The p-value step of a candidate; long ones get a larger share of the error."""
    # Length alone makes no secret: a run of one mark, however long, has no p-value.
    return F.when(p > 0, F.greatest(F.lit(0.0), p + F.log10(F.length(token) / F.lit(float(MEAN_LENGTH))))).otherwise(0.0)


def candidates(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))


def discovery_threshold(docs: DataFrame, model: TextModel, text: str = "text", fdr: float = FDR) -> float:
    """Least ``-log10 p`` that may be called a discovery (Benjamini-Hochberg on a grid of steps)."""
    t = F.col("t")
    tokens = docs.select(F.explode(candidates(whole(text))).alias("t"))
    # Of two candidates with equal p-values both count, so repeated documents shift nothing.
    steps = tokens.select(F.least(F.lit(STEPS), F.floor(10 * _weighted(combined_p_value(t, model), t))).cast("int").alias("step"))
    counts = dict(steps.groupBy("step").count().collect())  # at most STEPS + 1 rows
    total, above, best = sum(counts.values()), 0, float(STEPS)
    for step in range(STEPS, -1, -1):
        above += counts.get(step, 0)
        if above and total * 10 ** (-step / 10) <= fdr * above:
            best = step / 10
    return best


def random_spans(text: Column, threshold: float, model: TextModel) -> Column:
    """Spans of candidates that pass the threshold and the battery, of kind ``random``."""

    def passes(token: Column) -> Column:
        weight = _weighted(combined_p_value(token, model), token)
        return F.when((weight > 0) & (weight >= threshold), battery(token) <= MAX_Z).otherwise(False)

    return _spans(text, CANDIDATE, 3, "random", passes)


def scan_secrets(
    docs: DataFrame,
    text: str = "text",
    threshold: float | None = None,
    name: str = "secret_spans",
    model: TextModel | None = None,
) -> DataFrame:
    """Add the column ``name``: base spans, and random ones that no base span covers whole, by start and kind.

    A column of that name in ``docs`` is replaced. Without ``model`` and ``threshold`` both are taken from ``docs``.
    """
    model = learn_text(docs, text) if model is None else model
    threshold = discovery_threshold(docs, model, text) if threshold is None else threshold
    rows = docs.withColumn("_llm_text", whole(text))
    t = F.col("_llm_text")
    every = F.sort_array(F.concat(*base_spans(t), random_spans(t, threshold, model)))

    def fresh(spans: Column) -> Column:
        # In this order, base spans that begin no later come first: the farthest end of them decides.
        reach = _running(F.transform(spans, lambda s: F.when(s["kind"] < 3, s["end"]).otherwise(0)), F.greatest)
        told = F.zip_with(spans, reach, lambda s, far: F.struct(s.alias("s"), ((s["kind"] < 3) | (s["end"] > far)).alias("own")))
        return F.transform(F.filter(told, lambda x: x["own"]), lambda x: x["s"])

    return rows.withColumn(name, _bind(every, fresh)).drop("_llm_text")


def listed(spans: Column) -> Column:
    """``kind:start:end`` by start and kind, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["name"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by a mark; other texts are untouched."""
    rows = scan_secrets(docs, text, name="_llm_spans")
    spans, t = F.col("_llm_spans"), F.col(f"`{text}`")

    def cut(ctx: Column) -> Column:
        def piece(start: Column, end: Column | None) -> Column:
            first = F.floor(start / CHUNK).cast("int")
            n = F.lit(2**30) if end is None else F.floor(end / CHUNK).cast("int") - first + 1
            near = F.array_join(F.slice(ctx["chunks"], first + 1, n), "")
            return F.substring(near, start - first * CHUNK + 1, F.lit(2**30) if end is None else end - start)

        reach = ctx["reach"]
        told = F.transform(
            ctx["spans"], lambda s, i: F.struct(s["start"].alias("start"), F.when(i > 0, F.get(reach, i - 1)).otherwise(0).alias("at"))
        )
        # A span that begins inside an earlier one belongs to the same mark.
        heads = F.filter(told, lambda s: s["start"] >= s["at"])
        kept = F.transform(heads, lambda s: F.concat(piece(s["at"], s["start"]), F.lit(mark)))
        return F.concat(F.array_join(kept, ""), piece(F.element_at(reach, -1), None))

    # Chunks keep a cut near its place: a position in a long string is counted from its start.
    ctx = F.struct(
        spans.alias("spans"),
        _running(F.transform(spans, lambda s: s["end"]), F.greatest).alias("reach"),
        F.regexp_extract_all(t, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0)).alias("chunks"),
    )
    return rows.withColumn(text, F.when(F.size(spans) > 0, _bind(ctx, cut)).otherwise(t)).drop("_llm_spans")
