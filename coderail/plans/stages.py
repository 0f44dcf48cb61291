"""Shared pipeline stages over the fixtures: the inputs most registered queries start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import infer, joins, prep, prompt, validate
from .fixtures import fixture

CATEGORIES = ["quality", "toxic", "length"]


def entries_raw(spark: SparkSession, sf: str) -> DataFrame:
    return fixture(spark, sf, "entries_raw")


def entries(spark: SparkSession, sf: str) -> DataFrame:
    """Prepared texts (ordinal, title, description)."""
    return prep.prepare_entries(entries_raw(spark, sf))


def codes_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Wide human codes with stripped titles (duplicates kept)."""
    return joins.trimmed_codes(fixture(spark, sf, "codes_raw"))


def task_scheme(spark: SparkSession, sf: str) -> DataFrame:
    s = fixture(spark, sf, "task_scheme")
    ex = F.when(F.col("examples_text") == "", F.array().cast("array<string>")).otherwise(
        F.split(F.col("examples_text"), "\n", -1))
    return s.select("ordinal", "key", "display_name", "simplified_name", "criteria", ex.alias("examples"),
                    "values_text")


def tasks(spark: SparkSession, sf: str, num_partitions: int | None = None) -> DataFrame:
    """Pairs to code, on ``num_partitions`` tasks: texts are dealt out before each becomes several."""
    texts = entries(spark, sf)
    if num_partitions:
        texts = texts.repartition(num_partitions)
    return joins.build_tasks(texts, fixture(spark, sf, "selected"), task_scheme(spark, sf))


def prompts(spark: SparkSession, sf: str, num_partitions: int | None = None) -> DataFrame:
    return prompt.with_prompt_hash(prompt.construct_prompt(tasks(spark, sf, num_partitions)))


def resolved(spark: SparkSession, sf: str) -> DataFrame:
    return infer.resolve_attempts(fixture(spark, sf, "responses_raw"))


def category_positions(spark: SparkSession, sf: str) -> DataFrame:
    return joins.selected_categories(fixture(spark, sf, "selected"), task_scheme(spark, sf)).select(
        "cat_ordinal", F.col("key").alias("category"))


def coded(spark: SparkSession, sf: str) -> DataFrame:
    """Canonical long result: prepared texts x first good answer per pair, validated."""
    good, _ = infer.split_failures(resolved(spark, sf))
    e = entries(spark, sf)
    j = (good.select(F.col("doc_id").alias("ordinal"), "category", "response")
         .join(e, "ordinal", "inner")
         # No hint: the selection is tiny, and Spark broadcasts it by its own size check (planner
         # estimate, then AQE's run-time size) with a sort-merge join beyond the threshold.
         .join(category_positions(spark, sf), "category", "inner"))
    v = validate.validate_responses(j, "response")
    return v.select("ordinal", "cat_ordinal", "title", "description", "category", "ai_code", "confidence",
                    "confidence_level", "reasoning", "outcome")


def human_long(spark: SparkSession, sf: str) -> DataFrame:
    """Prepared human codes, one per (text, category), after the left merge; "0" where no code exists."""
    codes = prep.prepare_codes_wide(fixture(spark, sf, "codes_raw")).drop("ordinal")
    merged = joins.merge_codes(entries(spark, sf), codes)
    return joins.codes_long(merged, CATEGORIES)
