"""The corpus pipeline: its stages in order, and ``run``.

A stage takes (spark, docs, sf_dir), works on all documents its predecessor
kept, and returns a DataFrame that is written as Parquet and reread as the
next stage's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskspark.llm.exact_dedup import drop_exact_copies
from riskspark.llm.language import keep_identified
from riskspark.llm.mixing import repeat_mixed
from riskspark.llm.ngram_join import drop_similar
from riskspark.llm.packing import pack_documents
from riskspark.llm.queries import tokenizer_path
from riskspark.llm.shared import stage


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in some language or several; those without letters go."""
    return keep_identified(docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts one stays."""
    return drop_exact_copies(docs)


def similar_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by three quarters of their 5-word shingles,
    directly or through others, the one with the smallest id stays."""
    return drop_similar(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights; a document taken twice is two rows."""
    return repeat_mixed(docs)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus packed into sequences of 2048 tokens; one row a piece."""
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("language", language_stage),
    ("exact_dedup", dedup_stage),
    ("ngram_join", similar_stage),
    ("source_mix", mix_stage),
    ("best_fit_packing", pack_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
