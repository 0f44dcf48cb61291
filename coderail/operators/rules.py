"""Derived categories and code rules declared in the scheme (the reference parses them but never
evaluates them): any-in-range derivation, equality conditions, implied codes, disallowed codes.

The range rules are read once as the scheme's own list (one per derived category) and become
expressions; code tables are shuffled at most once. Other rule tables are joined plainly: Spark's own
size checks choose a broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scheme import allowed_codes, clean_name, is_open_values


def number_array(c) -> Column:
    """'2.1.4' -> [2, 1, 4]; arrays compare element-wise, so ranges over hierarchical numbers work."""
    col = F.col(c) if isinstance(c, str) else c
    return F.transform(F.split(col, r"\.", -1), lambda x: x.try_cast("int"))


def _number(text: str) -> list[int] | None:
    try:
        return [int(x) for x in text.split(".")]
    except (AttributeError, ValueError):
        return None


def _covers(rule, number: str) -> bool:
    n, a, b = _number(number), _number(rule["range_start"]), _number(rule["range_end"])
    return bool(n and a and b) and len(n) == len(a) and a <= n <= b


class RuleCycleError(ValueError):
    pass


def rule_levels(rules: Sequence[dict]) -> list[int]:
    """Evaluation order: a rule comes after the derived categories in its range (1 = none there)."""
    needs = [[j for j, r in enumerate(rules) if _covers(rule, r["number"])] for rule in rules]
    level = [0] * len(rules)
    for now in range(1, len(rules) + 1):
        ready = [i for i in range(len(rules)) if not level[i] and all(level[j] for j in needs[i])]
        for i in ready:
            level[i] = now
        if not ready:
            break
    if not all(level):
        raise RuleCycleError(f"conditions depend on each other: {[r['number'] for r, n in zip(rules, level) if not n]}")
    return level


def rules_from_conditions(scheme: DataFrame) -> tuple[DataFrame, list[tuple[str, str, str]]]:
    """The conditions of one scheme as rules: range rules ``(level, number, range_start, range_end, code)``
    for :func:`derive_any_in_range`, and equality rules ``(number, reference, value)`` for
    :func:`derive_equals`.

    The number is the one that leads the display name, the code the one that leads the value (the
    parsed value goes on with "oder nein (0)"), the reference its bare name without number and quotes.
    """
    spark = scheme.sparkSession
    lead = F.regexp_extract
    rows = scheme.filter(F.col("condition").isNotNull()).orderBy("ordinal").select(
        lead("display_name", r"^\s*(\d+(?:\.\d+)*)", 1).alias("number"), F.col("condition.type").alias("type"),
        F.lower(clean_name(F.regexp_replace("condition.reference", r"^[^0-9A-Za-z\u00c0-\u024f]+(\d+(\.\d+)*\.?\s*)?|^\d+(\.\d+)*\.?\s*", "")))
        .alias("reference"),
        lead("condition.range_start", r"(\d+(?:\.\d+)*)", 1).alias("range_start"),
        lead("condition.range_end", r"(\d+(?:\.\d+)*)", 1).alias("range_end"),
        lead("condition.value", r"^\s*(-?\d+)", 1).alias("code")).collect()
    ranges = [r.asDict() for r in rows if r["type"] == "any_in_range" and r["number"] and r["code"]]
    made = [(n, r["number"], r["range_start"], r["range_end"], r["code"]) for n, r in zip(rule_levels(ranges), ranges)]
    equals = [(r["number"], r["reference"], r["code"]) for r in rows if r["type"] == "equals" and r["number"]]
    return spark.createDataFrame(made, "level int, number string, range_start string, range_end string, code string"), equals


def derive_any_in_range(codes: DataFrame, rules: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Code "1" for a derived category when any category of the text whose number lies in
    [range_start, range_end] at the same depth as the range ends has the rule's code, else "0".

    ``rules(level, number, range_start, range_end, code)``; levels are evaluated in order and later
    levels see the results of earlier ones (2.0.4 ranges over 2.1-2.6, themselves derived).
    Returns ``(doc_id, number, code, level)`` for every text x derived category.

    One pass: each code row is compared with the rules where it is, one partial-aggregating group-by
    per text keeps a flag per rule, and every level is an expression over those flags. No join, no
    checkpoint, no second read of the codes.
    """
    own = [r.asDict() for r in rules.select("level", "number", "range_start", "range_end", "code").orderBy("level", "number").collect()]
    if not own:
        return codes.select(doc, "number", "code", F.lit(0).alias("level")).limit(0)

    def ints(text: str) -> Column:
        return F.array(*[F.lit(n) for n in _number(text) or []]).cast("array<int>")
    rows = codes.select(doc, "code", number_array("number").alias("_n"))
    hits = [F.bool_or((F.size("_n") == len(_number(r["range_start"]) or [])) & (F.col("_n") >= ints(r["range_start"]))
                      & (F.col("_n") <= ints(r["range_end"])) & (F.col("code") == r["code"])) for r in own]
    per_doc = rows.groupBy(doc).agg(*[F.coalesce(h, F.lit(False)).alias(f"_h{i}") for i, h in enumerate(hits)])
    for lv in sorted({r["level"] for r in own})[1:]:
        now = {}
        for i, r in enumerate(own):
            below = [j for j, d in enumerate(own) if d["level"] < lv and _covers(r, d["number"])]
            if r["level"] == lv and below and r["code"] in ("0", "1"):
                found = F.col(f"_h{i}")
                for j in below:
                    found = found | (F.col(f"_h{j}") if r["code"] == "1" else ~F.col(f"_h{j}"))
                now[f"_h{i}"] = found
        if now:
            per_doc = per_doc.withColumns(now)
    out = F.array(*[F.struct(F.lit(r["number"]).alias("number"), F.when(F.col(f"_h{i}"), "1").otherwise("0").alias("code"),
                             F.lit(r["level"]).alias("level")) for i, r in enumerate(own)])
    return per_doc.select(doc, F.inline(out))


def derive_equals(wide: DataFrame, rules: Sequence[tuple[str, str, str, str]], doc: str = "doc_id") -> DataFrame:
    """Equality conditions: derived category ``number`` takes the value of column ``source`` when
    column ``reference`` equals ``value``, otherwise "-99". ``rules = [(number, reference, value, source)]``
    (bounded by the scheme). One projection + generator over the text table: no join, no shuffle."""
    items = [F.struct(F.lit(n).alias("number"),
                      F.when(F.col(ref) == F.lit(v), F.col(src).cast("string")).otherwise(F.lit("-99")).alias("code"))
             for n, ref, v, src in rules]
    return wide.select(doc, F.inline(F.array(*items)))


def implied_codes(codes: DataFrame, rules: DataFrame, doc: str = "doc_id") -> DataFrame:
    """``rules(if_key, if_code, then_key, then_code)``: when a text has ``if_code`` for ``if_key``,
    its ``then_key`` code becomes ``then_code``. Returns all code rows with the rule applied and an
    ``implied`` flag for changed rows."""
    r = rules
    trig = (codes.join(r, (codes["number"] == r["if_key"]) & (codes["code"] == r["if_code"]), "inner")
            .groupBy(doc, F.col("then_key").alias("number")).agg(F.max("then_code").alias("_then")))
    j = codes.join(trig, [doc, "number"], "left")
    new = F.coalesce(F.col("_then"), F.col("code"))
    return j.select(doc, "number", new.alias("code"),
                    (F.col("_then").isNotNull() & (F.col("_then") != F.col("code"))).alias("implied"))


def disallowed_codes(codes: DataFrame, values: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Codes outside the category's allowed values (the ``(n)`` marks of its values text, plus -99
    when listed); open categories are exempt. ``values(category, values_text)`` is scheme-sized."""
    v = values.select("category", allowed_codes(F.col("values_text")).alias("_allowed"),
                      is_open_values(F.col("values_text")).alias("_open"))
    j = codes.join(v, "category", "inner")
    return j.filter(~F.col("_open") & ~F.array_contains(F.col("_allowed"), F.col("code"))).select(
        doc, "category", "code")
