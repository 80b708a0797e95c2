"""The registered queries of this subpackage, each over a whole table, and their SQL."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm import (
    codes,
    embeddings,
    lm,
    mixing,
    packing,
    products,
    quality,
    rulelist,
    secrets,
    simhash,
    suffixes,
    tries,
    urls,
)
from folioflow.llm.common import crc_fold
from folioflow.sources.pages import read_table

URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def op1_mix_sources(spark: SparkSession, d: str) -> DataFrame:
    plan = mixing.plan_mix(read_table(spark, d, "documents").select("doc_id", "text", "source"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op2_pack_sequences(spark: SparkSession, d: str) -> DataFrame:
    import public_tokenizers

    pieces = packing.pack(read_table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op3_quality_model(spark: SparkSession, d: str) -> DataFrame:
    docs, labels = (read_table(spark, d, t) for t in ("documents", "labels"))
    scored = quality.score_quality(docs.select("doc_id", "text"), labels)
    return scored.select(
        "doc_id", (crc_fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def _of_kind(kind: int, span: Column) -> Column:
    return span["kind"] == kind


def op4_secret_scan(spark: SparkSession, d: str) -> DataFrame:
    found = secrets.scan_secrets(read_table(spark, d, "documents").select("doc_id", "text")).drop("text")
    spans = F.col("secret_spans")
    base = F.filter(spans, lambda s: s["kind"] < 3)
    counts = [
        F.size(F.filter(spans, partial(_of_kind, k))).cast("long").alias(f"n_{name}") for k, name in enumerate(secrets.KINDS)
    ]
    return found.select(
        "doc_id", *counts, F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(spans).alias("spans")
    )


def op5_simhash(spark: SparkSession, d: str) -> DataFrame:
    found = simhash.simhash_components(read_table(spark, d, "documents").select("doc_id", "text"))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", hexed.alias("fingerprint"), F.col("component").alias("component_id"))


def op6_suffix_dedup(spark: SparkSession, d: str) -> DataFrame:
    cut = suffixes.remove_repeats(read_table(spark, d, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return cut.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op7_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    docs, labels = (read_table(spark, d, t) for t in ("documents", "labels"))
    judged = rulelist.judge_quality(docs.select("doc_id", "text"), labels)
    return judged.select("doc_id", *rulelist.STATS, "base_failed", "kept")


def op8_lm_score(spark: SparkSession, d: str) -> DataFrame:
    scored = lm.score_texts(read_table(spark, d, "documents").select("doc_id", "text"), crc_fold("doc_id", 7) != 2)
    return scored.withColumn("held_out", crc_fold("doc_id", 7) == 2)


def op9_url_filter(spark: SparkSession, d: str) -> DataFrame:
    judged = urls.judge_urls(read_table(spark, d, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op10_embedding_dedup(spark: SparkSession, d: str) -> DataFrame:
    return embeddings.near_vectors(read_table(spark, d, "embeddings"))


def op11_vector_codes(spark: SparkSession, d: str) -> DataFrame:
    coded = codes.compress_vectors(read_table(spark, d, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_top_products(spark: SparkSession, d: str) -> DataFrame:
    return products.top_products(read_table(spark, d, "embeddings"))


def op13_prefix_trie(spark: SparkSession, d: str) -> DataFrame:
    turns, convs = tries.turn_ids(read_table(spark, d, "conversations"))
    conv = F.col("conv")
    take = F.pmod(F.crc32(conv.cast("string").cast("binary")), F.lit(9))
    return tries.prefix_trie(*tries.graft(turns, convs, conv - conv % 5, take, 8))


QUERIES = {
    f.__name__: f
    for f in (
        op1_mix_sources,
        op2_pack_sequences,
        op3_quality_model,
        op4_secret_scan,
        op5_simhash,
        op6_suffix_dedup,
        op7_quality_rules,
        op8_lm_score,
        op9_url_filter,
        op10_embedding_dedup,
        op11_vector_codes,
        op12_top_products,
        op13_prefix_trie,
    )
}


def _refit(old: str, new: str) -> str:
    """One round over ``parts``: nearest entries of the codebooks ``old``, then their means as ``new``."""
    means = ", ".join(f"floor(sum(x[{i}])::DOUBLE / count(*))::BIGINT" for i in range(1, 5))
    return f"""
    near_{new} AS (
        SELECT vec_id, p, min({{'d': {_DISTANCE}, 'entry': entry}}) AS best
        FROM parts JOIN {old} USING (p) GROUP BY ALL
    ),
    mean_{new} AS (
        SELECT p, best.entry AS entry, [{means}] AS c FROM parts JOIN near_{new} USING (vec_id, p) GROUP BY ALL
    ),
    {new} AS (SELECT p, entry, coalesce(m.c, o.c) AS c FROM {old} o LEFT JOIN mean_{new} m USING (p, entry)),"""


_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
_DISTANCE = " + ".join(f"(x[{i}] - c[{i}]) * (x[{i}] - c[{i}])" for i in range(1, 5))

# Trained models, random rounding and byte work cannot be put into SQL; tests/llm has brute-force versions.
SQL: dict[str, str] = {
    "op11_vector_codes": f"""
    WITH kept AS (
        SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
        FROM embeddings WHERE {_FINITE}
    ),
    parts AS (SELECT vec_id, label, p, v[4 * p + 1 : 4 * p + 4] AS x FROM kept, range(16) r(p)),
    firsts AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT 64),
    b0 AS (SELECT p, entry, x AS c FROM parts JOIN firsts USING (vec_id)),
    {_refit("b0", "b1")}
    {_refit("b1", "b2")}
    last AS (
        SELECT vec_id, label, p, min({{'d': {_DISTANCE}, 'entry': entry}}) AS best
        FROM parts JOIN b2 USING (p) GROUP BY ALL
    ),
    coded AS (
        SELECT vec_id, label, string_agg(format('{{:02x}}', best.entry), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error
        FROM last GROUP BY vec_id, label
    ),
    books AS (
        SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, entry)) AS codebooks_sha256 FROM b2
    )
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
    FROM coded, books""",
    "op12_top_products": f"""
    WITH kept AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings WHERE {_FINITE}
    ),
    scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
        FROM kept q JOIN kept c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
    )
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
    FROM scored QUALIFY rank <= 10""",
    # CRC-32 is worked out from its polynomial, byte by byte of the decimal id.
    "op13_prefix_trie": """
    WITH crc_table AS (
        SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
            lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS v
    ),
    told AS (
        SELECT conv_id, list({'r': coalesce(role, ''), 'x': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS turns
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
    ),
    taking AS (
        SELECT conv_id, turns, xor(list_reduce(
            list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
            lambda c, b: xor(c >> 8, crc_table.v[(xor(c, b) & 255) + 1])), 4294967295) % 9 AS h
        FROM told, crc_table
    ),
    rebuilt AS (
        SELECT t.conv_id, list_concat(coalesce(b.turns[1 : h], []), t.turns[h + 1 :]) AS turns
        FROM taking t LEFT JOIN told b ON b.conv_id = t.conv_id - t.conv_id % 5
    ),
    members AS (
        SELECT conv_id, d, turns[1 : d] AS path, d = len(turns) AS ended FROM rebuilt, LATERAL (SELECT unnest(range(len(turns) + 1)) AS d)
    ),
    nodes AS (
        SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs,
            CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * strlen(path[d].x) END AS own,
            sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ended), '')) AS ends_sha256
        FROM members GROUP BY path, d
    ),
    children AS (SELECT path[1 : d - 1] AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
    told_nodes AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (path)),
    subtrees AS (
        SELECT path[1 : k] AS path, sum(own)::BIGINT AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves
        FROM told_nodes, LATERAL (SELECT unnest(range(d + 1)) AS k) GROUP BY 1
    )
    SELECT t.conv_id, t.d AS depth, p.conv_id AS parent_conv_id, t.n_convs, t.n_children, n_leaves, saved_tokens, t.ends_sha256
    FROM told_nodes t JOIN subtrees s ON s.path = t.path LEFT JOIN nodes p ON t.d > 0 AND p.path = t.path[1 : t.d - 1]""",
}
