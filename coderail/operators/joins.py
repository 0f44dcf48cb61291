"""Joins and set operations of the coding pipeline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import py_strip

def merge_codes(entries: DataFrame, codes: DataFrame, key: str = "title", fill: str = "0") -> DataFrame:
    """Left equi-join of texts with wide human codes on ``title`` (NULL matches NULL, as in pandas).

    Every column of ``codes`` comes along (one that the texts have too as ``<name>_codes``);
    ``human_code`` and ``human_code_*`` columns: missing -> "0", cast to string. Duplicate titles in
    ``codes`` multiply rows.

    Written as (texts INNER codes) UNION (texts ANTI distinct code titles) rather than one LEFT
    join: AQE splits skewed partitions of a left outer join on the left side only, so a title
    repeated across a large share of the codes would land whole in one task. The inner join can be
    split on either side; the anti join reads one row per code title. Both joins see the same text
    input, so its shuffle (if any) is reused, and an input already hash-partitioned on the key
    (after dedupe) is not reshuffled at all. Broadcast or sort-merge is AQE's runtime choice.
    """
    names = {c: f"{c}_codes" if c in entries.columns else c for c in codes.columns if c != key}
    all_cols, code_cols = list(names.values()), [n for c, n in names.items() if c == "human_code" or c.startswith("human_code_")]
    c = codes.select(F.col(key).alias("_k"), *[F.col(c).alias(n) for c, n in names.items()])
    # A non-nullable key never null-safe-equals NULL, so plain equality is the same join and keeps
    # the key as is: an input already hash-partitioned on it (e.g. after dedupe) is not reshuffled.
    def cond(right):
        return entries[key] == right["_k"] if not entries.schema[key].nullable else entries[key].eqNullSafe(right["_k"])
    matched = entries.join(c, cond(c), "inner").drop("_k")
    keys = c.select("_k").distinct()
    unmatched = entries.join(keys, cond(keys), "left_anti").select(
        "*", *[F.lit(None).cast(c.schema[col].dataType).alias(col) for col in all_cols])
    j = matched.unionByName(unmatched)
    return j.withColumns({col: F.coalesce(F.col(col).cast("string"), F.lit(fill)) for col in code_cols})


def codes_long(merged: DataFrame, categories: Sequence[str], ids: Sequence[str] = ("ordinal", "title"),
               fill: str = "0") -> DataFrame:
    """Per merged row and category the column ``human_code_<category>``, "0" when it does not exist.

    A projection + generator (no join, no shuffle): each row fans out to one row per category.
    """
    cols = set(merged.columns)
    pairs = [F.struct(F.lit(cat).alias("category"),
                      (F.coalesce(F.col(f"human_code_{cat}").cast("string"), F.lit(fill))
                       if f"human_code_{cat}" in cols else F.lit(fill)).alias("human_code"))
             for cat in categories]
    return merged.select(*ids, F.inline(F.array(*pairs)))


def dedupe_selection(selected: DataFrame) -> DataFrame:
    """Repeated selections count once, at their first position."""
    return selected.groupBy("key").agg(F.min("ordinal").alias("ordinal")).select("ordinal", "key")


def _aliases(scheme: DataFrame) -> DataFrame:
    """(alias, key) of one scheme: its keys and, where it has them, its simplified names."""
    s = scheme.withColumn("_one", F.lit(1))
    if "simplified_name" not in scheme.columns:
        s = s.withColumn("simplified_name", F.lit(None).cast("string"))
    return scheme_aliases(s, group="_one").select("alias", "key")


def selected_categories(selected: DataFrame, scheme: DataFrame) -> DataFrame:
    """Known selections, by key or simplified name, joined with their scheme row; each category once,
    at its first position (unknown names are skipped)."""
    known = selected.withColumnRenamed("key", "alias").join(_aliases(scheme), "alias").select("ordinal", "key")
    sel = dedupe_selection(known).withColumnRenamed("ordinal", "cat_ordinal")
    return sel.join(scheme.drop("ordinal"), "key", "inner")


def unknown_categories(selected: DataFrame, scheme: DataFrame) -> DataFrame:
    """Selected names that are neither a key nor a simplified name (the reference warns and skips them)."""
    return selected.join(_aliases(scheme).select(F.col("alias").alias("key")), "key", "left_anti").select("ordinal", "key")


def build_tasks(entries: DataFrame, selected: DataFrame, scheme: DataFrame,
                cat_cols: Sequence[str] = ("display_name", "criteria", "examples", "values_text"),
                max_selected: int | None = None) -> DataFrame:
    """Texts x selected categories (the task table), in entry order then selection order.

    The selection is what a user picked from the menu: it is read once and fanned out with a
    generator, so no join and no shuffle happens and every entry partition emits its own tasks where
    it is. ``max_selected`` (off by default) refuses a selection by mistake of a whole table.
    Nothing selected -> empty task table.
    """
    cats = selected_categories(selected, scheme).select("cat_ordinal", F.col("key").alias("category"), *cat_cols)
    rows = cats.orderBy("cat_ordinal").collect()
    if max_selected is not None and len(rows) > max_selected:
        raise ValueError(f"{len(rows)} selected categories, more than {max_selected}")
    if not rows:
        return entries.select("*", F.lit(None).cast("int").alias("cat_ordinal"),
                              F.lit(None).cast("string").alias("category"),
                              *[F.lit(None).cast(cats.schema[c].dataType).alias(c) for c in cat_cols]).limit(0)
    structs = [F.struct(*[F.lit(r[c]).cast(cats.schema[c].dataType).alias(c) for c in cats.columns]) for r in rows]
    return entries.select("*", F.inline(F.array(*structs)))


def title_mismatch(entries: DataFrame, codes: DataFrame, key: str = "title") -> DataFrame:
    """Titles missing in the codes and titles only in the codes (set semantics, both ways).

    Both title sets are tagged with their side, unioned and grouped once by title (partial
    aggregation): a title seen on one side only is a mismatch. One shuffle and no joins. NULL
    titles count as equal, as in Python sets (grouping treats NULL as one key)."""
    marks = (entries.select(F.col(key), F.lit(1).alias("_e"), F.lit(0).alias("_c"))
             .unionByName(codes.select(F.col(key), F.lit(0).alias("_e"), F.lit(1).alias("_c"))))
    g = marks.groupBy(key).agg(F.max("_e").alias("_e"), F.max("_c").alias("_c"))
    side = (F.when(F.col("_c") == 0, F.lit("missing_in_codes"))
            .when(F.col("_e") == 0, F.lit("extra_in_codes")))
    return g.filter(F.col("_e") != F.col("_c")).select(side.alias("side"), F.col(key))


def scheme_aliases(scheme: DataFrame, group: str = "scheme_id", order: str = "ordinal") -> DataFrame:
    """Lookup by key or by simplified name. Insertion order is key_1, simplified_1, key_2, ...;
    on collision the later insertion wins. A partial-aggregating ``max_by``, no window."""
    k = scheme.select(group, F.col("key").alias("alias"), "key", (F.col(order) * 2).alias("_pos"))
    s = scheme.filter(F.col("simplified_name").isNotNull()).select(
        group, F.col("simplified_name").alias("alias"), "key", (F.col(order) * 2 + 1).alias("_pos"))
    u = k.unionByName(s)
    return u.groupBy(group, "alias").agg(F.max_by("key", "_pos").alias("key"))


def pending_tasks(tasks: DataFrame, responses: DataFrame,
                  keys: Sequence[str] = ("prompt_hash", "model", "temperature")) -> DataFrame:
    """Tasks without a stored response for the same (prompt hash, model, temperature).

    The idempotency key makes a re-run (or a retried Spark task) skip work that was already paid for.
    """
    return tasks.join(responses.select(*keys).distinct(), list(keys), "left_anti")


def trimmed_codes(codes: DataFrame, key: str = "title") -> DataFrame:
    return codes.withColumn(key, py_strip(F.col(key)))
