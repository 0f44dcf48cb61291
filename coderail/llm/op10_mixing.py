"""Mixing sources to target weights by subset-sum budget fitting on document lengths.

Per source the documents are counted by exact length.  A budget of at least the whole source takes every document
once more; what remains is fitted: an even share of each length, then whole documents until the rest fits a window,
then bounded-knapsack dynamic programming over the lengths still free.  Which documents of a length are taken follows
a seeded hash, so reruns agree.  Counts are grouped by (source, length, hash bucket) before any ranking: a hot source
or length is ranked bucket by bucket, never in one task.

Null text: length 0, nothing taken.  Null source: a source of its own, last.  Null ``doc_id``: ranked by its text.
Repeated rows: each counts and may be taken.  Empty table: no rows.  Other columns are carried by ``mix``.
The per-source plan reads one row per distinct length, whatever the number of documents.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coderail.llm.common import WORD, materialise, table

#: Target weights, dealt to the sources in code point order, again and again.
WEIGHTS = (1, 2, 3)
#: No document is taken more often.
MAX_COPIES = 3
#: Largest rest that the dynamic programme fits, in words.
WINDOW = 1 << 16
BUCKETS = 1024


def fit(sizes: np.ndarray, counts: np.ndarray, budget: int, window: int = WINDOW) -> np.ndarray:
    """How many documents of each length to take (at most ``counts``) so that their words come near ``budget``
    without exceeding it."""
    take = np.zeros(len(sizes), np.int64)
    total = int(sizes @ counts)
    if budget <= 0 or total == 0:
        return take
    if budget >= total:
        return counts.copy()
    take = np.array([c * budget // total for c in counts.tolist()], np.int64)
    rest, free = budget - int(sizes @ take), counts - take
    for i in np.argsort(-sizes, kind="stable").tolist():
        if rest <= window:
            break
        size = int(sizes[i])
        if size:
            n = min(int(free[i]), rest // size, -(-(rest - window) // size))
            take[i], free[i], rest = take[i] + n, free[i] - n, rest - n * size
    goal = min(rest, window)
    by, items = np.full(goal + 1, -1, np.int32), []  # by[s]: the item that first reached the sum s
    reached = np.zeros(goal + 1, bool)
    reached[0] = True
    for i in np.argsort(-sizes, kind="stable").tolist():
        size, left, step = int(sizes[i]), int(free[i]), 1
        left = min(left, goal // size) if size else 0
        while left and not reached[goal]:
            n = min(step, left)
            new = reached[: goal + 1 - n * size] & ~reached[n * size :]
            at = np.flatnonzero(new) + n * size
            by[at] = len(items)
            reached[at] = True
            items.append((i, n))
            left, step = left - n, step * 2
    best = int(np.flatnonzero(reached)[-1])
    while best:
        i, n = items[by[best]]
        take[i] += n
        best -= n * int(sizes[i])
    return take


def targets(sources: DataFrame, cap: int = MAX_COPIES) -> DataFrame:
    """``target`` of each source (columns skey, source, source_size): weight times a common level, at most ``cap``
    times its size, so that the targets add up to all sizes.  One row per source is ranked and summed."""
    rank = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*map(F.lit, WEIGHTS))
    w = sources.withColumn("w", F.get(cycle, (F.row_number().over(rank) - 1) % len(WEIGHTS)))
    w = w.withColumn("most", cap * F.col("source_size"))
    before = Window.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = ((F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0)))
             / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0))))
    w = w.withColumn("level", level)
    open_ = F.col("level") * F.col("w") < F.col("most")  # sources are capped in this order up to the first open one
    common = F.max(F.when(open_, F.col("level"))).over(everything)
    w = w.withColumn("common", common)
    return w.select("skey", "source_size",
                    F.when(F.col("common").isNull(), F.col("most").cast("double"))
                    .otherwise(F.least(F.col("common") * F.col("w"), F.col("most").cast("double"))).alias("target"))


def _plan(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of one source: whole copies and the documents of each length taken once more."""
    total, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
    whole = min(MAX_COPIES, int(target // total)) if total else 0
    rest = 0 if whole == MAX_COPIES else round(target - whole * total)
    pdf = pdf.sort_values("size")
    take = fit(pdf["size"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64), rest)
    return pdf[["skey", "size", "source_size", "target"]].assign(whole=whole, take=take)


def mix(docs: DataFrame, seed: int = 42, size: Column | None = None) -> DataFrame:
    """``docs`` as the struct ``doc``, with size, source_size, target and copies (0 to 3) of each document."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)) if size is None else size
    h = F.xxhash64("doc_id", "text", F.lit(seed))
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc"), size.cast("long").alias("size"),
                       F.col("source"), h.alias("h"),
                       F.when(F.col("source").isNull(), "-").otherwise(F.concat(F.lit("+"), "source")).alias("skey"),
                       F.pmod(h, F.lit(BUCKETS)).alias("bucket"))
    keys = ["skey", "size", "bucket"]
    counts = materialise(rows.groupBy("source", *keys).agg(F.count("*").alias("n")), "mix_counts")
    by_source = counts.groupBy("source", "skey").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    lengths = counts.groupBy("skey", "size").agg(F.sum("n").alias("n"))
    plan = (lengths.join(targets(by_source), "skey").groupBy("skey")
            .applyInPandas(_plan, "skey string, size long, source_size long, target double, whole int, take long"))
    before = Window.partitionBy("skey", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    quota = (counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).join(plan, ["skey", "size"])
             .select(*keys, "source_size", "target", "whole", (F.col("take") - F.col("before")).alias("once_more")))
    quota = materialise(quota, "mix_quota")
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("h", "doc.doc_id"))
    return (rows.withColumn("place", place).join(quota, keys)
            .select("doc", "size", "source_size", "target",
                    (F.col("whole") + (F.col("place") <= F.col("once_more")).cast("int")).alias("copies")))


def mixed_documents(docs: DataFrame, seed: int = 42) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken."""
    return (mix(docs, seed).where("copies > 0").select("doc", F.explode(F.sequence(F.lit(1), "copies")))
            .select("doc.*"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    slim = docs.select("doc_id", "source", F.xxhash64("text").alias("text"),
                       F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).alias("words"))
    out = mix(slim, size=F.col("words"))
    return out.select("doc.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
