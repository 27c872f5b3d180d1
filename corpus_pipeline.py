"""Corpus preparation: five stages over the documents table, each one operator applied to all that the stage before kept.

Each stage takes (spark, docs, sf_dir) and returns the columns of documents; the last returns the packed
pieces. ``run`` writes each stage's result to the shared checkpoint folder and reads it back as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfspark.llm import jaccard, lines, packing, quality, repeats
from shelfspark.llm.common import kept_table, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or whose host is rejected."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out lines that are near copies of an earlier line; documents left without a word go."""
    return lines.drop_lines(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    return jaccard.keep_one(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out passages of over 50 words, and byte strings of 400 bytes and more, that start at two places; documents left without a word go."""
    return repeats.drop_repeats(docs, words=repeats.PASSAGE_WORDS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the token ids of what is left into sequences of 2048."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("suffix_array_dedup", suffix_array_dedup),
    ("best_fit_packing", best_fit_packing),
]

# No SQL: line classes, n-gram classes and token ids cannot be expressed; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
