"""Any-in-range rules of many schemes at once, on tables of any length.

A category's code is derived from the codes of the categories whose number lies in a range ("2.1.1-2.1.4 = 1"). Numbers are
hierarchical: ``2.1.10`` is an array of integers and ranges compare arrays of one depth.

* Whether a rule covers a number depends on scheme, number and code only, so the range join meets the distinct
  ones, never the texts. Its bins: a range between ``p.a.*`` and ``p.b.*`` covers the prefix ``p`` and, behind it, the blocks
  of a width (a power of ``FAN``) that ``a..b`` touches, at most ``FAN + 1``; a number looks only in bins of prefix
  lengths and widths that rules of its scheme and depth have.
* Rules may range over derived categories. The rules that each one covers come from the same range join, levels
  from a recursive common table expression; a circle is an error.
* Per text, the rules that its own codes hit are one array; the levels are one fold over the scheme's rules in
  order. Texts are shuffled once, by (scheme, text).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .rules import RuleCycleError, number_array

#: Blocks that a range is cut into, about, and the levels that conditions may lie above each other.
FAN = 64
MAX_LEVELS = 64


def _prefix(numbers: Column, length: Column) -> Column:
    return F.array_join(F.slice(numbers, F.lit(1), length).cast("array<string>"), ".")


def _bins(rules: DataFrame) -> DataFrame:
    """Rules (with arrays ``_a``, ``_b`` of one depth) by bin: depth, prefix length, width, prefix and block."""
    depth = F.size("_a")
    same = F.aggregate(F.sequence(F.lit(1), depth), F.lit(0),
                       lambda n, i: F.when((n == i - 1) & (F.element_at("_a", i) == F.element_at("_b", i)), i).otherwise(n))
    out = rules.withColumns({"_depth": depth, "_len": F.least(same, depth - 1)})
    low, high = F.element_at("_a", F.col("_len") + 1), F.element_at("_b", F.col("_len") + 1)
    # width 0 stands for blocks of one number, 1 for FAN numbers, 2 for FAN * FAN ...
    wide = F.ceil(F.log(F.greatest((high - low + 1) / F.lit(FAN), F.lit(1.0))) / F.log(F.lit(float(FAN)))).cast("int")
    out = out.withColumns({"_wide": F.greatest(wide, F.lit(0)), "_low": low, "_high": high})
    block = F.pow(F.lit(float(FAN)), F.col("_wide"))
    blocks = F.sequence(F.floor(F.col("_low") / block), F.floor(F.col("_high") / block))
    return out.withColumn("_prefix", _prefix(F.col("_a"), F.col("_len"))).withColumn("_block", F.explode(blocks)).drop("_low", "_high")


def covered(numbers: DataFrame, rules: DataFrame, group: str = "scheme_id") -> DataFrame:
    """(scheme, number, rule): the distinct ``numbers(scheme, number)`` in each rule's range. Rules whose ends are no numbers of
    one depth, and numbers that are none, cover and are covered by nothing."""
    r = rules.select(group, F.col("number").alias("rule"), number_array("range_start").alias("_a"), number_array("range_end").alias("_b"))
    plain = ~F.exists("_a", lambda x: x.isNull()) & ~F.exists("_b", lambda x: x.isNull())
    r = _bins(r.where((F.size("_a") == F.size("_b")) & plain & (F.col("_a") <= F.col("_b"))))
    n = numbers.select(group, "number").distinct().withColumn("_n", number_array("number"))
    n = n.where(~F.exists("_n", lambda x: x.isNull())).withColumn("_depth", F.size("_n"))
    shapes = r.select(group, "_depth", "_len", "_wide").distinct()
    n = n.join(shapes, [group, "_depth"]).withColumns({
        "_prefix": _prefix(F.col("_n"), F.col("_len")),
        "_block": F.floor(F.element_at("_n", F.col("_len") + 1) / F.pow(F.lit(float(FAN)), F.col("_wide")))})
    met = n.join(r, [group, "_depth", "_len", "_wide", "_prefix", "_block"])
    return met.where((F.col("_n") >= F.col("_a")) & (F.col("_n") <= F.col("_b"))).select(group, "number", "rule")


def with_levels(rules: DataFrame, group: str = "scheme_id") -> DataFrame:
    """``rules`` with ``needs`` (the derived categories in the rule's range) and ``level`` (1, or one above the highest of
    them), written once. Raises :class:`RuleCycleError` where conditions depend on each other in a circle (or lie
    deeper than ``MAX_LEVELS``)."""
    spark = rules.sparkSession
    path = scratch_path(spark, "range_rules")
    deps = covered(rules, rules, group)
    deps.write.parquet(path + "/deps")
    deps = spark.read.schema(deps.schema).parquet(path + "/deps")
    names = {"rules": f"coderail_rules_{id(rules)}", "deps": f"coderail_deps_{id(rules)}"}
    rules.select(F.col(group).alias("g"), F.col("number").alias("rule")).distinct().createOrReplaceTempView(names["rules"])
    deps.select(F.col(group).alias("g"), "rule", F.col("number").alias("dep")).createOrReplaceTempView(names["deps"])
    levels = spark.sql(f"""
        WITH RECURSIVE t(g, rule, level) MAX RECURSION LEVEL {MAX_LEVELS} AS (
          SELECT g, rule, 1 FROM {names['rules']}
          UNION ALL SELECT DISTINCT d.g, d.rule, t.level + 1 FROM t JOIN {names['deps']} d ON d.g = t.g AND d.dep = t.rule)
        SELECT g AS {group}, rule AS number, max(level) AS level FROM t GROUP BY g, rule""")
    needs = (deps.select(group, F.col("rule").alias("_rule"), "number").groupBy(group, F.col("_rule").alias("number"))
             .agg(F.collect_set("number").alias("needs")))
    try:
        levels.write.parquet(path + "/levels")
    except Exception as e:  # the limit comes as a plain error of the JVM
        if "RECURSION_LEVEL_LIMIT_EXCEEDED" in str(e):
            raise RuleCycleError(f"conditions depend on each other in a circle, or lie more than {MAX_LEVELS} levels deep") from e
        raise
    finally:
        for view in names.values():
            spark.catalog.dropTempView(view)
    levels = spark.read.schema(levels.schema).parquet(path + "/levels")
    out = rules.join(levels, [group, "number"]).join(needs, [group, "number"], "left")
    return out.withColumn("needs", F.coalesce("needs", F.array().cast("array<string>")))


def derive_ranges(codes: DataFrame, rules: DataFrame, doc: str = "doc_id", group: str = "scheme_id") -> DataFrame:
    """(scheme, text, number, code, level) for every text and every derived category of its scheme: "1" where any category in
    the range has the rule's code, the text's own codes and derived ones of lower levels alike, else "0".

    ``codes(scheme, text, number, code)``, ``rules(scheme, number, range_start, range_end, code)``, one rule per (scheme, number).
    Rows with a NULL scheme match nothing; texts come out if they have any code in a scheme with rules."""
    rules = with_levels(rules.select(group, "number", "range_start", "range_end", "code"), group)
    hits = covered(codes, rules, group).join(rules.select(group, F.col("number").alias("rule"), "code"), [group, "rule"])
    hits = hits.groupBy(group, "number", "code").agg(F.collect_set("rule").alias("_hits"))
    # One row per category of a scheme and code: small beside the codes, whose skewed keys adaptive execution splits.
    per_text = codes.select(group, doc, "number", "code").join(hits, [group, "number", "code"], "left").groupBy(group, doc).agg(
        F.array_distinct(F.flatten(F.collect_list(F.coalesce("_hits", F.array().cast("array<string>"))))).alias("_hits"))
    order = rules.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("level", "number", "code", "needs"))).alias("_rules"))

    def next_rule(found: Column, r: Column) -> Column:
        below = F.when(r["code"] == "1", F.arrays_overlap(r["needs"], found)).when(
            r["code"] == "0", F.size(F.array_except(r["needs"], found)) > 0).otherwise(F.lit(False))
        return F.when(below & ~F.array_contains(found, r["number"]), F.array_append(found, r["number"])).otherwise(found)

    found = F.aggregate("_rules", F.col("_hits"), next_rule)
    done = per_text.join(order, group).withColumn("_found", found)
    rows = F.transform("_rules", lambda r: F.struct(
        r["number"].alias("number"), F.when(F.array_contains("_found", r["number"]), "1").otherwise("0").alias("code"), r["level"].alias("level")))
    return done.select(group, doc, F.inline(rows))
