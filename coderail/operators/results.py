"""Results: wide table, per-category metrics, progress, agreement with human coders, review queue.

The canonical result is the long table ``coded`` (one row per text x category) with columns
ordinal, cat_ordinal, title, description, category, ai_code, confidence, confidence_level, reasoning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import collapse_whitespace, format_2dp, normalise_code


def task_order(ordinal: str = "ordinal", cat_ordinal: str = "cat_ordinal"):
    """Position of a result in the reference's loop: entry order, then selection order."""
    return F.struct(F.col(ordinal), F.col(cat_ordinal))


def wide_results(coded: DataFrame, categories: Sequence[str], key: str = "title",
                 entries: DataFrame | None = None) -> DataFrame:
    """One row per title: first description (collapsed whitespace), and per category the normalised
    code, the confidence as "%.2f" and the reasoning of the **last** result for that pair.

    Columns: title, description, ai_<c>..., confidence_<c>..., reasoning_<c>... with categories
    sorted by code point; absent pairs are NULL. Built as ONE aggregation over ``title`` with
    conditional ``max_by`` per category (what ``pivot`` with an explicit value list does, minus its
    second aggregation): the partial aggregate shrinks hot titles before the shuffle.

    ``entries`` (the de-duplicated texts ``coded`` was built from: one row per title) lets the
    aggregation carry the small cells only; descriptions are joined back on the title. ``coded``
    then never moves a description, where it otherwise carries one per category and row, and
    texts hash-partitioned on the title by their dedupe are joined without another shuffle.
    """
    cats = sorted(dict.fromkeys(categories))
    order = task_order()
    cell = F.struct(normalise_code(F.col("ai_code")).alias("ai"), format_2dp(F.col("confidence")).alias("conf"),
                    F.col("reasoning").alias("reason"))
    aggs = [F.max_by(cell, F.when(F.col("category") == c, order)).alias(f"_c{i}") for i, c in enumerate(cats)]
    if entries is None:
        g = coded.groupBy(key).agg(F.min_by(F.col("description"), order).alias("_desc"), *aggs)
    else:
        g = entries.select(key, F.col("description").alias("_desc")).join(coded.groupBy(key).agg(*aggs), key)
    cols = [F.col(key), collapse_whitespace(F.col("_desc")).alias("description")]
    cols += [F.col(f"_c{i}.ai").alias(f"ai_{c}") for i, c in enumerate(cats)]
    cols += [F.col(f"_c{i}.conf").alias(f"confidence_{c}") for i, c in enumerate(cats)]
    cols += [F.col(f"_c{i}.reason").alias(f"reasoning_{c}") for i, c in enumerate(cats)]
    return g.select(*cols)


def title_collisions(coded: DataFrame, key: str = "title") -> DataFrame:
    """Titles that carry more than one description: the wide table keys by title (as the
    reference does) and keeps the first description, so these texts collapse there.

    Exact and skew-safe: min and max of a description hash per title (partial aggregation), no
    distinct set of texts is built."""
    h = F.sha2(F.col("description"), 256)
    g = coded.groupBy(key).agg(F.min(h).alias("_lo"), F.max(h).alias("_hi"),
                               F.count(F.lit(1)).alias("n_rows"))
    return g.filter(F.col("_lo") != F.col("_hi")).select(key, "n_rows")


def category_metrics(coded: DataFrame, normalised: bool = False) -> DataFrame:
    """Per category: rows, rows whose code equals "1" (raw code unless ``normalised``), mean confidence."""
    code = normalise_code(F.col("ai_code")) if normalised else F.col("ai_code")
    return coded.groupBy("category").agg(
        F.count(F.lit(1)).alias("total_samples"),
        F.count_if(code == "1").alias("positive_classifications"),
        F.round(F.avg("confidence"), 4).alias("average_confidence"))


def overall_metrics(coded: DataFrame) -> DataFrame:
    """Per-category figures plus the overall row in one pass (``rollup`` + ``grouping``)."""
    return coded.rollup("category").agg(
        F.when(F.grouping("category") == 1, "overall").otherwise("category").alias("scope"),
        F.count(F.lit(1)).alias("total_samples"),
        F.count_if(F.col("ai_code") == "1").alias("positive_classifications"),
        F.round(F.avg("confidence"), 4).alias("average_confidence"))


def run_progress(tasks: DataFrame, coded: DataFrame, keys=("ordinal", "category")) -> DataFrame:
    """Finished pairs per category and overall: n_tasks, n_done, truncated integer percent (0 when
    there are no tasks; the reference divides by zero).

    One union and one partial-aggregating group-by per pair (how many task rows it has, whether any
    result exists), then the rollup: no distinct of the results and no join with the tasks."""
    keys = list(keys)
    marks = (tasks.select(*keys, F.lit(1).alias("_t"), F.lit(0).alias("_d"))
             .unionByName(coded.select(*keys, F.lit(0).alias("_t"), F.lit(1).alias("_d"))))
    per_pair = marks.groupBy(*keys).agg(F.sum("_t").alias("_t"), F.max("_d").alias("_d")).filter(F.col("_t") > 0)
    agg = per_pair.rollup("category").agg(F.sum("_t").cast("bigint").alias("n_tasks"),
                                          F.sum(F.when(F.col("_d") == 1, F.col("_t")).otherwise(F.lit(0)))
                                          .cast("bigint").alias("n_done"))
    pct = F.when(F.col("n_tasks") == 0, F.lit(0)).otherwise(F.floor(F.col("n_done") * 100 / F.col("n_tasks")))
    return agg.select(F.coalesce("category", F.lit("_overall")).alias("category"), "n_tasks", "n_done",
                      pct.cast("bigint").alias("pct_done"))


def paired_codes(coded: DataFrame, human: DataFrame, keys=("ordinal", "category")) -> DataFrame:
    """Model code (normalised) next to the human code of the same text and category."""
    a = coded.select(*keys, normalise_code(F.col("ai_code")).alias("ai_code"), "confidence", "title")
    return a.join(human.select(*keys, "human_code"), list(keys), "inner")


def confusion_counts(paired: DataFrame, codes: Sequence[str] = ("0", "1")) -> DataFrame:
    """Cells behind the agreement figures: rows per (category, human code, model code).

    Every category has all cells over ``codes``, empty ones as 0; further codes appear where they occur."""
    counted = paired.groupBy("category", "human_code", "ai_code").agg(F.count(F.lit(1)).alias("n"))
    if not codes:
        return counted
    zero = F.array(*[F.struct(F.lit(h).alias("human_code"), F.lit(a).alias("ai_code"), F.lit(0).cast("bigint").alias("n"))
                     for h in codes for a in codes])
    zeros = paired.select("category").distinct().select("category", F.inline(zero))
    return counted.unionByName(zeros).groupBy("category", "human_code", "ai_code").agg(F.sum("n").alias("n"))


def agreement_kappa(paired: DataFrame) -> DataFrame:
    """Per category: n, observed agreement, chance agreement sum_k p_ai(k) p_h(k), Cohen's kappa
    (NULL when chance agreement is 1).

    A linear chain of partial-aggregating steps, no join and no second read of any input: pairs ->
    confusion cells; each cell fans out to its human-code row and its model-code row -> per
    (category, code) both marginals and the agreeing count -> per category the totals and the
    chance term. Nothing is collected per category: the model's code is free text after
    normalisation, so the number of codes of a category has no proven bound.
    """
    cells = confusion_counts(paired, ())
    n, zero = F.col("n"), F.lit(0).cast("bigint")
    agree = F.when(F.col("human_code") == F.col("ai_code"), n).otherwise(zero)
    sides = cells.select("category", F.inline(F.array(
        F.struct(F.col("human_code").alias("code"), n.alias("nh"), zero.alias("na"), agree.alias("ag")),
        F.struct(F.col("ai_code").alias("code"), zero.alias("nh"), n.alias("na"), zero.alias("ag")))))
    per_code = sides.groupBy("category", "code").agg(F.sum("nh").alias("nh"), F.sum("na").alias("na"),
                                                     F.sum("ag").alias("ag"))
    # a NULL code never equals another, so it adds to the totals but not to the chance term
    t = per_code.groupBy("category").agg(
        F.sum("nh").alias("n_pairs"), F.sum("ag").alias("n_agree"),
        F.sum(F.when(F.col("code").isNotNull(), F.col("nh").cast("double") * F.col("na"))
              .otherwise(F.lit(0.0))).alias("_hxa"))
    nd = F.col("n_pairs").cast("double")
    po = F.col("n_agree") / nd
    pe = F.col("_hxa") / (nd * nd)
    kappa = F.when(pe == 1, F.lit(None).cast("double")).otherwise((po - pe) / (1 - pe))
    return t.select("category", F.col("n_pairs").cast("bigint").alias("n_pairs"), F.round(po, 4).alias("observed"),
                    F.round(pe, 4).alias("expected"), F.round(kappa, 4).alias("kappa"))


def confidence_distribution(coded: DataFrame) -> DataFrame:
    """Rows per category and confidence band, zero-filled (a pivot with a fixed value list)."""
    lv = F.col("confidence_level")
    return coded.groupBy("category").agg(*[F.count_if(lv == x).alias(f"n_{x}") for x in ("low", "medium", "high")])


def review_queue(paired: DataFrame, k: int = 5, low_below: float = 0.33) -> DataFrame:
    """Rows to re-read: low confidence or disagreement with the human coder; per category the k
    with the lowest confidence (ties: title, then ordinal).

    ``row_number() <= k`` is planned with a per-partition group limit before the shuffle, so each
    map task forwards at most k rows per category even when one category dominates.
    """
    cand = paired.filter((F.col("confidence") < low_below) | (F.col("ai_code") != F.col("human_code")))
    w = Window.partitionBy("category").orderBy("confidence", "title", "ordinal")
    return (cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("category", F.col("rank").cast("bigint").alias("rank"), "ordinal", "title", "confidence",
                    "ai_code", "human_code"))
