"""The corpus pipeline: quality rules, near-duplicates, repeated passages, source weights, packing.

Each stage works on all that its predecessor kept, written as Parquet and read again; all but the last return the
columns of ``documents``.  Null, empty and very long texts, ties, repeated rows, empty tables and further columns are
handled as the operators' docstrings say; a document without ``doc_id`` goes through like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from coderail.llm.common import free_name, materialise, release, table
from coderail.llm.op04_quality import judge, model_of
from coderail.llm.op05_simhash import near_duplicates_kept
from coderail.llm.op06_chaining import without_passages
from coderail.llm.op09_packing import pack_documents
from coderail.llm.op10_mixing import mixed_documents
from coderail.llm.tokens import default_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the classifier reject go."""
    verdict = free_name(docs, "q_")
    return judge(docs, model_of(docs, table(spark, sf_dir, "labels")), verdict).where(f"{verdict}.kept").drop(verdict)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays (4-word shingles, at most 4 differing bits)."""
    return near_duplicates_kept(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut out of the text."""
    return without_passages(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target weight takes it."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens; one row per piece of a document."""
    return pack_documents(docs, default_path())


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", simhash_near_dedup),
    ("substring dedup", substring_dedup),
    ("mixing sources", source_mix),
    ("packing", packing),
]

#: SQL cannot express the classifier, the tokenizer and the chaining; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), "pipeline_" + name.replace(" ", "_"))
        release(spark)
    return docs
