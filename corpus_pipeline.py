"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a table that is written and read
again as the next one's ``docs``. All but the last return the columns of ``documents``.
Null and empty texts, repeated rows and extra columns pass as the operators define it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm import mixing, packing, quality, secrets, simhash
from folioflow.session import cut_lineage
from folioflow.sources.pages import read_table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier trained on ``labels`` rejects go."""
    return quality.keep_quality(docs, read_table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    return simhash.drop_near_copies(docs)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; no document goes."""
    clean = secrets.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weights of their sources want them, twice at most."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their token ids and their place in a sequence."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", drop_copies),
    ("secret scans", hide_secrets),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]

#: Trained scores, random rounding and token ids cannot be put into SQL; tests/llm checks each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
