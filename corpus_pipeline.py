"""From raw documents to packed sequences, in five stages.

Each stage gets what the one before it kept, written as Parquet and read again. The
first four return documents; the last returns pieces of sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from feedsieve.llm import exact_dedup, ngram_join, packing, suffix_dedup, toxicity
from feedsieve.llm.common import stored
from feedsieve.llm.queries import SEQUENCE, TOXIC_FROM, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, lets pass."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model, TOXIC_FROM)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest id."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group connected by similar shingles, the document with the smallest id."""
    return ngram_join.keep_smallest(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that occur twice."""
    return suffix_dedup.without_repeats(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and offset."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), SEQUENCE)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("packing", pack_sequences),
]

# Tokens, a learnt classifier and connected components are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
