"""From raw documents to packed sequences: five stages, each a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ordstrata.llm.common import read_table, stored
from ordstrata.llm.decontamination import without_leaks
from ordstrata.llm.near_dups import without_near_duplicates
from ordstrata.llm.packing import pack
from ordstrata.llm.pii import redacted
from ordstrata.llm.quality_rules import without_rejected
from ordstrata.llm.queries import word_tokenizer

# Near duplicates here: five-word shingles that share at least 80 percent of their union.
SHINGLE_WORDS, PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules reject go."""
    return without_rejected(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return without_near_duplicates(docs, SHINGLE_WORDS, PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to their kind; ``n_chars`` follows."""
    return redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequences."""
    return pack(docs, word_tokenizer())


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pii", pii),
    ("packing", packing),
]

# Expectation-maximisation, signatures and the span field are beyond SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
