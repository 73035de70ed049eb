"""A document pipeline whose stages each call one operator of ``vacantia.llm``.

Every stage works on all documents that the one before it kept, and its decisions take effect; all but
the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vacantia.llm import dart, hosts, nnpu, packing, phrases
from vacantia.session import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = nnpu.score_toxicity(docs, labels, carry=("lang", "source", "n_chars"), with_text=True)
    return scored.filter("predicted = 0").select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose host does not fail them too often."""
    return hosts.judge_hosts(docs, carry=("text", "lang", "source", "n_chars")).filter("kept").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return dart.keep_one(docs).select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 13 words or more that an earlier document has."""
    out = phrases.remove_repeated_phrases(docs, carry=["lang", "source"])
    return out.selectExpr("doc_id", "kept_text text", "lang", "source", "cast(length(kept_text) as long) n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all texts in training sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, work in STAGES:
        docs = stage(work(spark, docs, sf_dir), name)
    return docs
