"""Registered queries for the derived-category rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scheme import parse_condition
from ..operators import rules as R
from .catalog import register
from .fixtures import fixture, register_tables

# Equality conditions of the deployed scheme (derived number, reference, value, source).
EQUALS_RULES = [("1.0.4", "provider", "1", "open_text"), ("1.0.5", "provider", "1", "open_text"),
                ("1.0.7", "provider", "2", "open_text"), ("1.0.8", "provider", "2", "open_text")]
# Implication stated in the scheme text (2.2.2 = 1 forces 3.3 = 1).
IMPLIED_RULES = [("2.2.2", "1", "3.3", "1")]
# Allowed-values texts of the categories the code fixtures use.
PROVIDER_VALUES = "Hochschule (1), externer Anbieter (2)"
BINARY_VALUES = "Ja (1), Nein (0)"


def _num(c: str) -> str:
    return f"list_transform(string_split({c}, '.'), lambda x: TRY_CAST(x AS INTEGER))"


def _level_sql(src: str, lv: int) -> str:
    return f"""
SELECT p.doc_id, p.number, CASE WHEN h.any_hit = 1 THEN '1' ELSE '0' END AS code, {lv} AS level
FROM (SELECT d.doc_id, r.number FROM (SELECT DISTINCT doc_id FROM leaf_codes) d
      CROSS JOIN (SELECT number FROM derived_rules WHERE level = {lv}) r) p
LEFT JOIN (SELECT c.doc_id, r.number, max(CASE WHEN c.code = r.code THEN 1 ELSE 0 END) AS any_hit
           FROM {src} c JOIN derived_rules r ON r.level = {lv} AND len({_num('c.number')}) = len({_num('r.range_start')})
             AND {_num('c.number')} >= {_num('r.range_start')} AND {_num('c.number')} <= {_num('r.range_end')}
           GROUP BY c.doc_id, r.number) h ON p.doc_id = h.doc_id AND p.number = h.number"""


_DERIVED_SQL = f"""
WITH d1 AS ({_level_sql('leaf_codes', 1)}),
 c1 AS (SELECT doc_id, number, code FROM leaf_codes UNION ALL SELECT doc_id, number, code FROM d1),
 d2 AS ({_level_sql('c1', 2)})
SELECT * FROM d1 UNION ALL SELECT * FROM d2"""


@register("derive_any_in_range", _DERIVED_SQL, ("leaf_codes", "derived_rules"))
def q_derive_any_in_range(spark, sf):
    out = R.derive_any_in_range(fixture(spark, sf, "leaf_codes"), fixture(spark, sf, "derived_rules"))
    return out.withColumn("level", F.col("level").cast("int"))


@register("derive_from_conditions", _DERIVED_SQL, ("leaf_codes", "derived_rules"))
def q_derive_from_conditions(spark, sf):
    """The same rules, read out of the values texts of a scheme: number from the display name, code from
    the parsed value, levels from what the ranges cover."""
    r = fixture(spark, sf, "derived_rules")
    text = F.concat(F.lit("Ja ("), "code", F.lit(") wenn min. eine der Kategorien "), "range_start", F.lit("-"), "range_end",
                    F.lit(" = "), "code", F.lit("\noder Nein (0)"))
    scheme = r.select(F.monotonically_increasing_id().alias("ordinal"), F.concat("number", F.lit(" Kategorie")).alias("display_name"),
                      parse_condition(text).alias("condition"))
    ranges, _ = R.rules_from_conditions(scheme)
    return R.derive_any_in_range(fixture(spark, sf, "leaf_codes"), ranges)


# Rule tables of many schemes, made from the parts: 20 schemes, a rule per part. Two thirds of the rules range over leaf categories
# (2.x.y or 3.y), the others over up to three derived categories of smaller numbers, so conditions lie several levels deep.
_MANY_RULES = """
SELECT p_partkey % 20 AS scheme_id, concat('9.', CAST(p_partkey / 20 AS STRING)) AS number,
  CASE WHEN p_partkey % 3 = 0 AND p_partkey > 60 THEN concat('9.', CAST(p_partkey / 20 - 2 - p_size % 3 AS STRING))
       WHEN p_size % 4 = 0 THEN concat('3.', CAST(1 + p_size % 5 AS STRING))
       ELSE concat('2.', CAST(1 + p_size % 6 AS STRING), '.', CAST(1 + p_partkey % 4 AS STRING)) END AS range_start,
  CASE WHEN p_partkey % 3 = 0 AND p_partkey > 60 THEN concat('9.', CAST(p_partkey / 20 - 1 AS STRING))
       WHEN p_size % 4 = 0 THEN '3.5'
       ELSE concat('2.', CAST(1 + p_size % 6 + p_partkey % 2 AS STRING), '.', CAST(2 + p_partkey % 5 AS STRING)) END AS range_end,
  CASE WHEN p_partkey % 3 <> 0 AND p_size % 11 = 0 THEN '-99' ELSE '1' END AS code
FROM part WHERE p_partkey / 20 <= 60
"""
_MANY_DUCK = _MANY_RULES.replace("/ 20", "// 20").replace("AS STRING", "AS VARCHAR")


@register("derive_many_schemes", f"""
WITH RECURSIVE r AS ({_MANY_DUCK}), leaf AS (SELECT doc_id % 20 AS scheme_id, doc_id, number, code FROM leaf_codes),
 deps AS (SELECT a.scheme_id, a.number AS rule, b.number AS dep FROM r a JOIN r b ON a.scheme_id = b.scheme_id
   AND len({_num('a.range_start')}) = len({_num('b.number')}) AND {_num('b.number')} BETWEEN {_num('a.range_start')} AND {_num('a.range_end')}
   AND a.code = '1'),
 lv AS (SELECT scheme_id, number, 1 AS level FROM r UNION SELECT d.scheme_id, d.rule, lv.level + 1 FROM lv JOIN deps d
   ON d.scheme_id = lv.scheme_id AND d.dep = lv.number),
 below AS (SELECT scheme_id, number AS rule, number AS dep FROM r UNION SELECT b.scheme_id, b.rule, d.dep FROM below b JOIN deps d
   ON d.scheme_id = b.scheme_id AND d.rule = b.dep),
 hit AS (SELECT DISTINCT l.scheme_id, l.doc_id, r.number FROM leaf l JOIN r ON r.scheme_id = l.scheme_id AND r.code = l.code
   AND len({_num('r.range_start')}) = len({_num('l.number')}) AND {_num('l.number')} BETWEEN {_num('r.range_start')} AND {_num('r.range_end')}),
 fired AS (SELECT DISTINCT h.scheme_id, h.doc_id, b.rule FROM hit h JOIN below b ON b.scheme_id = h.scheme_id AND b.dep = h.number)
SELECT d.scheme_id, d.doc_id, r.number, CASE WHEN f.rule IS NULL THEN '0' ELSE '1' END AS code, CAST(m.level AS INTEGER) AS level
FROM (SELECT DISTINCT scheme_id, doc_id FROM leaf) d JOIN r ON r.scheme_id = d.scheme_id
JOIN (SELECT scheme_id, number, max(level) AS level FROM lv GROUP BY ALL) m ON m.scheme_id = r.scheme_id AND m.number = r.number
LEFT JOIN fired f ON f.scheme_id = d.scheme_id AND f.doc_id = d.doc_id AND f.rule = r.number""", ("leaf_codes",))
def q_derive_many_schemes(spark, sf):
    """Range rules of twenty schemes at once: bins for the ranges, levels by a recursive query, nothing collected."""
    from ..operators.range_rules import derive_ranges
    leaf = fixture(spark, sf, "leaf_codes").select((F.col("doc_id") % 20).alias("scheme_id"), "doc_id", "number", "code")
    register_tables(spark, sf, ["part"])
    rules = spark.sql(_MANY_RULES.replace("p_partkey / 20", "p_partkey div 20"))
    return derive_ranges(leaf, rules)


@register("derive_equals", " UNION ALL ".join(
    f"SELECT doc_id, '{n}' AS number, CASE WHEN {ref} = '{v}' THEN CAST({src} AS VARCHAR) ELSE '-99' END AS code "
    f"FROM provider_codes" for n, ref, v, src in EQUALS_RULES), ("provider_codes",))
def q_derive_equals(spark, sf):
    return R.derive_equals(fixture(spark, sf, "provider_codes"), EQUALS_RULES)


_IMPLIED_VALUES = ", ".join(f"('{a}', '{b}', '{c}', '{d}')" for a, b, c, d in IMPLIED_RULES)


@register("implied_codes", f"""
WITH r AS (SELECT * FROM (VALUES {_IMPLIED_VALUES}) AS t(if_key, if_code, then_key, then_code)),
 trig AS (SELECT l.doc_id, r.then_key AS number, max(r.then_code) AS then_code FROM leaf_codes l JOIN r
          ON l.number = r.if_key AND l.code = r.if_code GROUP BY ALL)
SELECT l.doc_id, l.number, coalesce(t.then_code, l.code) AS code,
  coalesce(t.then_code IS NOT NULL AND t.then_code <> l.code, false) AS implied
FROM leaf_codes l LEFT JOIN trig t ON l.doc_id = t.doc_id AND l.number = t.number""", ("leaf_codes",))
def q_implied_codes(spark, sf):
    rules = spark.createDataFrame(IMPLIED_RULES, "if_key string, if_code string, then_key string, then_code string")
    return R.implied_codes(fixture(spark, sf, "leaf_codes"), rules)


def _codes_long(spark, sf):
    leaf = fixture(spark, sf, "leaf_codes").select("doc_id", F.col("number").alias("category"), "code")
    prov = fixture(spark, sf, "provider_codes")
    return leaf.unionByName(prov.select("doc_id", F.lit("provider").alias("category"), F.col("provider").alias("code"))) \
        .unionByName(prov.select("doc_id", F.lit("open_text").alias("category"), F.col("open_text").alias("code")))


@register("disallowed_codes", f"""
SELECT doc_id, category, code FROM (
  SELECT doc_id, number AS category, code FROM leaf_codes
  UNION ALL SELECT doc_id, 'provider', provider FROM provider_codes
  UNION ALL SELECT doc_id, 'open_text', open_text FROM provider_codes)
WHERE (category = 'provider' AND code NOT IN ('1', '2'))
   OR (category NOT IN ('provider', 'open_text') AND code NOT IN ('1', '0'))""", ("leaf_codes", "provider_codes"))
def q_disallowed_codes(spark, sf):
    leaf_values = fixture(spark, sf, "leaf_codes").select(F.col("number").alias("category")).distinct() \
        .withColumn("values_text", F.lit(BINARY_VALUES))
    fixed = spark.createDataFrame([("provider", PROVIDER_VALUES), ("open_text", "offen")],
                                  "category string, values_text string")
    return R.disallowed_codes(_codes_long(spark, sf), leaf_values.unionByName(fixed))
