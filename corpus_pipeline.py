"""A corpus prepared in five stages. Each gets the documents its predecessor kept, written and reread.

quality rules -> one document of each near-duplicate group -> repeated passages out ->
documents with test items out -> packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from colsight.llm import op1_decontaminate, op2_packing, op5_substring, op6_jaccard, op9_quality
from colsight.llm.common import load, stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the policy keeps; rows without doc_id are judged as all others."""
    return op9_quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at Jaccard 0.8 or more of their five-word shingles."""
    return op6_jaccard.keep_one(docs, k=5, num=80, den=100)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-word windows that an earlier document has."""
    return op5_substring.remove_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a test item."""
    return op1_decontaminate.decontaminate(docs, load(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place."""
    return op2_packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packing),
]

# tokens can't be said in SQL; the tests run every stage against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for i, (_, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs)
    return docs
