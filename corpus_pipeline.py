"""A training corpus from raw documents: language, near duplicates, benchmark leaks, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last return the columns of
documents. Stages are tied together by written tables in the shared folder, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontam, jaccard, language, packing, secret_scan
from tidemark.llm.queries import settings, table
from tidemark.session import drop_scratch, durable, scratch_mark

# A language filter learned from the data and the tokenizer's ids have no form in SQL; tests compare with plain code.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters or in no learned language go."""
    settings(spark)
    return language.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near duplicates stays."""
    return jaccard.keep_one(docs, jaccard.jaccard_components(docs))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain at least four fifths of a benchmark item go."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text; every document stays."""
    return secret_scan.redact_secrets(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and place in it."""
    return packing.pack(packing.token_pieces(docs, packing.default_vocabulary()))


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark", drop_benchmark_leaks),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before = scratch_mark()
        docs = durable(stage(spark, docs, sf_dir), name)
        drop_scratch(spark, before, scratch_mark() - 1)  # what the stage staged, but not its result
    return STAGES[-1][1](spark, docs, sf_dir)
