"""Preparation of texts and human codes: trim, drop missing, project, first-wins dedupe, recode.

Order of steps follows the reference script: strip -> drop missing -> project -> dedupe (-> recode).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import py_strip


class MissingColumnsError(ValueError):
    pass


def require_columns(df: DataFrame, cols: Sequence[str]) -> None:
    """Plan-time check (no job): every required column must exist."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise MissingColumnsError(f"Missing required columns: {missing}")


def trim_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """``str.strip()`` on each listed column (Unicode whitespace, both ends; '' stays '')."""
    return df.withColumns({c: py_strip(F.col(c)) for c in cols})


def drop_missing(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Rows with NULL in any listed column go; empty strings are kept.

    The logical plan does not narrow nullability after a filter, so the kept columns are restated
    as non-nullable (an identity ``coalesce`` after the filter). Later joins on them then keep
    plain equi-join keys and reuse an existing hash partitioning."""
    cond = None
    for c in subset:
        p = F.col(c).isNotNull()
        cond = p if cond is None else cond & p
    if cond is None:
        return df
    out = df.filter(cond)
    return out.withColumns({c: F.coalesce(F.col(c), F.lit("").cast(df.schema[c].dataType)) for c in subset})


def dedupe_first(df: DataFrame, keys: Sequence[str], order: str = "ordinal") -> DataFrame:
    """Keep the first row (smallest ``order``) per key.

    Expressed as an aggregate rather than a window: the aggregate combines partially on the map
    side, so a key that holds a third of all rows is reduced to one row per map task before the
    shuffle instead of landing whole in one task. Every column is its own ``min_by`` over the
    (unique) order, so all of them come from the same row, and Catalyst prunes the aggregates a
    consumer does not read: a plan that only needs the surviving ordinals never shuffles the texts.
    ``order`` must be unique per row, as the input position added at ingest is; with ties the
    columns of one key could come from different rows. NULL keys form one group, as in pandas.
    """
    rest = [c for c in df.columns if c not in keys]
    aggs = [(F.min(F.col(c)) if c == order else F.min_by(F.col(c), F.col(order))).alias(c) for c in rest]
    return df.groupBy(*keys).agg(*aggs).select(*df.columns)


def prepare_entries(df: DataFrame, order: str = "ordinal") -> DataFrame:
    """Texts: strip title/description, drop missing, keep (ordinal, title, description), first title wins."""
    require_columns(df, ["title", "description"])
    # strip keeps NULL as NULL and never makes one, so dropping missing rows first is the same
    # result and lets the NULL test run on the raw columns (and reach the scan) instead of on trim().
    out = drop_missing(df.select(order, "title", "description"), ["title", "description"])
    out = trim_columns(out, ["title", "description"])
    return dedupe_first(out, ["title"], order)


def integral_text(c: Column) -> Column:
    """'1.0' -> '1' (a numeric code column read with blanks turns into floats). Other text unchanged."""
    return F.regexp_replace(c, r"^(-?\d+)\.0+$", "$1")


def recode_invalid(df: DataFrame, col: str = "human_code", allowed: Sequence[str] = ("0", "1"),
                   default: str = "0", flag: str | None = None) -> DataFrame:
    """Codes outside ``allowed`` become ``default``; with ``flag`` a boolean column marks recoded rows."""
    v = integral_text(F.col(col).cast("string"))
    ok = v.isin(*allowed)
    out = df
    if flag:
        out = out.withColumn(flag, ~F.coalesce(ok, F.lit(False)))
    return out.withColumn(col, F.when(ok, v).otherwise(F.lit(default)))


def recode_report(df: DataFrame, col: str = "human_code", allowed: Sequence[str] = ("0", "1")) -> DataFrame:
    """Rows and recoded rows in one pass (the reference only prints the count)."""
    v = integral_text(F.col(col).cast("string"))
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_if(~F.coalesce(v.isin(*allowed), F.lit(False))).alias("n_recoded"))


def prepare_codes(df: DataFrame, code_col: str = "human_code", order: str = "ordinal") -> DataFrame:
    """Human codes: strip title, project, drop missing, dedupe (before recoding), recode to {0, 1}."""
    require_columns(df, ["title", code_col])
    out = drop_missing(df.select(order, "title", code_col), ["title", code_col])
    out = trim_columns(out, ["title"])
    out = dedupe_first(out, ["title"], order)
    return recode_invalid(out, code_col)


def prepare_codes_wide(df: DataFrame, order: str = "ordinal") -> DataFrame:
    """Wide human codes ready to merge: strip title, drop rows without one, first title wins, every
    ``human_code_*`` column recoded to {0, 1} (missing stays missing: the merge fills it)."""
    require_columns(df, ["title"])
    cols = [c for c in df.columns if c.startswith("human_code_")]
    out = dedupe_first(trim_columns(drop_missing(df.select(order, "title", *cols), ["title"]), ["title"]), ["title"], order)
    for c in cols:
        out = recode_invalid(out.withColumn("_was", F.col(c)), c).withColumn(c, F.when(F.col("_was").isNotNull(), F.col(c))).drop("_was")
    return out


# The entry record rules.
CODE_PATTERN = r"^[01]$"


def entry_violations(df: DataFrame, order: str = "ordinal") -> DataFrame:
    """One row per failed rule of an entry record: title and description must be text, human_code
    must match ``^[01]$`` (a missing code defaults to "0")."""
    rules = F.array(
        F.when(F.col("title").isNull(), F.lit("title_not_string")),
        F.when(F.col("description").isNull(), F.lit("description_not_string")),
        F.when(~F.coalesce(F.col("human_code"), F.lit("0")).rlike(CODE_PATTERN), F.lit("human_code_pattern")),
    )
    return (df.select(order, F.explode(F.filter(rules, lambda r: r.isNotNull())).alias("rule")))


def valid_entries(df: DataFrame) -> DataFrame:
    """The clean side of :func:`entry_violations`."""
    return df.filter(F.col("title").isNotNull() & F.col("description").isNotNull()
                     & F.coalesce(F.col("human_code"), F.lit("0")).rlike(CODE_PATTERN))


def limit_entries(df: DataFrame, n: int, order: str = "ordinal") -> DataFrame:
    """Sample mode for texts: the first ``n`` in input order (a limit is the feature here)."""
    return df.orderBy(order).limit(n)


def limit_categories(scheme: DataFrame, n: int, group: str = "scheme_id", order: str = "ordinal") -> DataFrame:
    """Sample mode for schemes: the first ``n`` categories of every scheme in scheme order.

    ``row_number() <= n`` lets Spark insert a per-partition group limit before the shuffle, so a
    large scheme does not travel whole to one task.
    """
    from pyspark.sql import Window
    w = Window.partitionBy(group).orderBy(order)
    return scheme.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")
