"""A corpus from raw documents to packed sequences: quality, exact and near copies, mixing, packing.

Every stage takes ``(spark, docs, sf_dir)``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidegate.llm import exact, jaccard, mixing, packing, quality
from tidegate.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that fail a rule; documents that are rejected go."""
    return quality.clean(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact.deduplicate(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, a similarity of 0.8 or more."""
    return jaccard.distinct_documents(docs, width=5, threshold=0.8)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in the proportions of their weights; a document has a row for each pass that takes of it."""
    return mixing.mix(docs)


def packing_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), 2048)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", ngram_jaccard),
    ("mixing sources to target weights", mixing_sources),
    ("packing", packing_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, "pipeline")
    return docs


# SQL can express neither the tokenizer nor the drawn mix; the tests hold the rows against brute force.
ORACLE_SQL = None
