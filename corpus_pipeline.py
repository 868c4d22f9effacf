"""The corpus pipeline: quality rules, toxicity, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last return the columns of
``documents``.

Defined cases are those of the operators: documents without text fail the quality rules; rows without doc_id are kept by all
later stages as they are; repeated rows are judged alike; an empty table passes through as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulsegrid.llm import jaccard, packing, quality, substrings, toxicity
from pulsegrid.llm.queries import table, tokenizer_path
from pulsegrid.llm.shared import kept


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or a certified cutoff go."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return toxicity.clean_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents stays, the one with the smallest doc_id."""
    return jaccard.one_of_each_group(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 or more words that a smaller document holds go; what stays keeps its white space."""
    return substrings.shortened(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all remaining documents in sequences of 4096 tokens."""
    return packing.digests(packing.packed_pieces(docs, tokenizer_path("word_bpe_49k.json")))


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("near duplicates", near_duplicates),
    ("substring dedup", substring_dedup),
    ("packing", pack),
]
#: The classifier, the components and the tokenizer are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
