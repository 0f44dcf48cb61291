"""Registered queries for the scheme-table operators (S1-S17, I3, J6) over the ``scheme_rows`` fixture."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scheme as S
from ..functions.text import py_strip
from ..operators import joins
from ..sources import scheme_documents
from ..operators import scheme as OS
from ..session import scratch_path
from . import sqlfn as Q
from .catalog import CTES, register
from .fixtures import fixture, register_tables


def rows(spark, sf):
    return fixture(spark, sf, "scheme_rows")


def normalised(spark, sf):
    return OS.normalise_scheme(rows(spark, sf))


_K = Q.sort_key("display_name")
_C = Q.condition("v")

CTES.update({
    "o_scheme_base": (f"""
SELECT scheme_id, ordinal, display_name, v, c, e, {Q.generate_key('display_name')} AS gkey FROM (
  SELECT scheme_id, ordinal, {Q.strip('display_name')} AS display_name, {Q.strip('values_text')} AS v,
         {Q.strip('criteria')} AS c, {Q.strip('examples')} AS e FROM scheme_rows)
WHERE NOT (display_name = '' AND v = '' AND c = '' AND e = '')""", ("scheme_rows",)),
    "o_scheme_k": (f"""
SELECT scheme_id, ordinal, display_name, CASE WHEN {_C['cond_type']} IS NOT NULL THEN '_DERIVED_' || gkey ELSE gkey END
    AS key0, {Q.import_criteria('c')} AS criteria, {Q.example_lines('e')} AS examples,
  {Q.standardise_values(Q.values_prestep('v'))} AS values_text,
  {_C['cond_type']} AS cond_type, {_C['reference']} AS reference, {_C['range_start']} AS range_start,
  {_C['range_end']} AS range_end, {_C['cond_value']} AS cond_value, {_C['condition_problem']} AS condition_problem
FROM o_scheme_base WHERE gkey <> ''""", ("o_scheme_base",)),
    "o_scheme": (f"""
SELECT scheme_id, ordinal, display_name, CASE WHEN rn = 0 THEN key0 ELSE key0 || '_' || CAST(rn AS VARCHAR) END AS key,
  {Q.clean_name('display_name')} AS simplified_name, criteria, examples, values_text, cond_type, reference,
  range_start, range_end, cond_value, condition_problem
FROM (SELECT *, row_number() OVER (PARTITION BY scheme_id, key0 ORDER BY ordinal) - 1 AS rn FROM o_scheme_k)""",
                 ("o_scheme_k",)),
})

_SCHEME_OUT = ("scheme_id, ordinal, key, display_name, simplified_name, criteria, "
               "array_to_string(examples, chr(10)) AS examples_text, values_text, cond_type, reference, range_start, "
               "range_end, cond_value")


def _scheme_out(df, *extra):
    return df.select("scheme_id", "ordinal", "key", "display_name", "simplified_name", "criteria",
                     F.array_join("examples", "\n").alias("examples_text"), "values_text",
                     F.col("condition.type").alias("cond_type"), F.col("condition.reference").alias("reference"),
                     F.col("condition.range_start").alias("range_start"),
                     F.col("condition.range_end").alias("range_end"), F.col("condition.value").alias("cond_value"),
                     *extra)


@register("category_sort_key", f"SELECT scheme_id, ordinal, {_K['n1']} AS n1, {_K['n2']} AS n2, {_K['n3']} AS n3, "
          f"{_K['suffix']} AS suffix FROM scheme_rows", ("scheme_rows",))
def q_category_sort_key(spark, sf):
    k = S.category_sort_key(F.col("display_name"))
    return rows(spark, sf).select("scheme_id", "ordinal", k["n1"].alias("n1"), k["n2"].alias("n2"),
                                  k["n3"].alias("n3"), k["suffix"].alias("suffix"))


@register("filter_categories", f"""
SELECT scheme_id, ordinal, display_name, {_K['n1']} AS n1, {_K['n2']} AS n2, {_K['n3']} AS n3, {_K['suffix']} AS suffix
FROM scheme_rows WHERE coalesce(regexp_matches({Q.first_token('display_name')}, '[0-9]'), false)""", ("scheme_rows",))
def q_filter_categories(spark, sf):
    return OS.filter_categories(rows(spark, sf)).select("scheme_id", "ordinal", "display_name", "n1", "n2", "n3",
                                                        "suffix")


@register("generate_key", f"SELECT scheme_id, ordinal, {Q.generate_key('display_name')} AS key FROM scheme_rows",
          ("scheme_rows",))
def q_generate_key(spark, sf):
    return rows(spark, sf).select("scheme_id", "ordinal", S.generate_key(F.col("display_name")).alias("key"))


@register("unique_keys", """
SELECT scheme_id, ordinal, CASE WHEN rn = 0 THEN k ELSE k || '_' || CAST(rn AS VARCHAR) END AS key FROM (
  SELECT *, row_number() OVER (PARTITION BY scheme_id, k ORDER BY ordinal) - 1 AS rn FROM (
    SELECT scheme_id, ordinal, """ + Q.generate_key("display_name") + """ AS k FROM scheme_rows) WHERE k <> '')""",
          ("scheme_rows",))
def q_unique_keys(spark, sf):
    k = rows(spark, sf).select("scheme_id", "ordinal", S.generate_key(F.col("display_name")).alias("key"))
    return OS.unique_keys(k)


# Keys of one family in one scheme, with numbers that are taken by other keys before or after they are given.
_CLASHING = """SELECT p_partkey % 20 AS scheme_id, p_partkey AS ordinal,
  CASE p_size % 9 WHEN 0 THEN 'Foo' WHEN 1 THEN 'Foo' WHEN 2 THEN 'Foo_1' WHEN 3 THEN 'Foo_3' WHEN 4 THEN 'Foo_1_1' WHEN 5 THEN 'Bar'
    WHEN 6 THEN 'Bar_2' WHEN 7 THEN concat('Foo_', CAST(p_partkey % 30 AS STRING)) ELSE 'Foo_01' END AS key FROM part"""


@register("unique_keys_clashing", f"""
WITH RECURSIVE k AS (SELECT *, row_number() OVER (PARTITION BY scheme_id ORDER BY ordinal) AS pos FROM ({_CLASHING.replace('AS STRING', 'AS VARCHAR')})),
 t AS (SELECT scheme_id, CAST(0 AS BIGINT) AS pos, CAST([] AS VARCHAR[]) AS used FROM (SELECT DISTINCT scheme_id FROM k)
   UNION ALL SELECT t.scheme_id, k.pos, list_append(t.used, CASE WHEN NOT list_contains(t.used, k.key) THEN k.key ELSE
     k.key || '_' || CAST(list_min(list_filter(range(1, len(t.used) + 2), lambda n: NOT list_contains(t.used, k.key || '_' || CAST(n AS VARCHAR)))) AS VARCHAR) END)
   FROM t JOIN k ON k.scheme_id = t.scheme_id AND k.pos = t.pos + 1)
SELECT k.scheme_id, k.ordinal, t.used[t.pos] AS key FROM t JOIN k ON k.scheme_id = t.scheme_id AND k.pos = t.pos""")
def q_unique_keys_clashing(spark, sf):
    """Repeated keys beside keys that have, or will take, the numbers given to them."""
    register_tables(spark, sf, ["part"])
    return OS.unique_keys(spark.sql(_CLASHING))


_C_RAW = Q.condition(Q.strip("values_text"))


@register("parse_condition", f"""
SELECT scheme_id, ordinal, {_C_RAW['cond_type']} AS cond_type, {_C_RAW['reference']} AS reference,
  {_C_RAW['range_start']} AS range_start, {_C_RAW['range_end']} AS range_end, {_C_RAW['cond_value']} AS cond_value,
  {_C_RAW['condition_problem']} AS condition_problem FROM scheme_rows""", ("scheme_rows",))
def q_parse_condition(spark, sf):
    v = py_strip(F.col("values_text"))
    c = S.parse_condition(v)
    return rows(spark, sf).select("scheme_id", "ordinal", c["type"].alias("cond_type"),
                                  c["reference"].alias("reference"), c["range_start"].alias("range_start"),
                                  c["range_end"].alias("range_end"), c["value"].alias("cond_value"),
                                  S.condition_problem(v).alias("condition_problem"))


@register("standardise_values", f"""
SELECT scheme_id, ordinal, {Q.standardise_values(Q.values_prestep(Q.strip('values_text')))} AS values_text
FROM scheme_rows""", ("scheme_rows",))
def q_standardise_values(spark, sf):
    v = S.standardise_values(S.values_prestep(py_strip(F.col("values_text"))))
    return rows(spark, sf).select("scheme_id", "ordinal", v.alias("values_text"))


@register("simplify_name", f"""
SELECT scheme_id, ordinal, {Q.simplify_name('display_name')} AS simplified FROM scheme_rows""", ("scheme_rows",))
def q_simplify_name(spark, sf):
    return rows(spark, sf).select("scheme_id", "ordinal", S.simplify_name(F.col("display_name")).alias("simplified"))


@register("clean_name", f"SELECT scheme_id, ordinal, {Q.clean_name('display_name')} AS clean FROM scheme_rows",
          ("scheme_rows",))
def q_clean_name(spark, sf):
    return rows(spark, sf).select("scheme_id", "ordinal", S.clean_name(F.col("display_name")).alias("clean"))


@register("clean_criteria", f"""
SELECT scheme_id, ordinal, {Q.clean_criteria('criteria')} AS criteria_fixed,
  {Q.import_criteria('criteria')} AS criteria_imported FROM scheme_rows""", ("scheme_rows",))
def q_clean_criteria(spark, sf):
    return rows(spark, sf).select("scheme_id", "ordinal", S.clean_criteria(F.col("criteria")).alias("criteria_fixed"),
                                  S.import_criteria(F.col("criteria")).alias("criteria_imported"))


@register("clean_examples", f"""
SELECT scheme_id, ordinal, CAST(len({Q.example_lines('examples')}) AS INTEGER) AS n_examples,
  array_to_string({Q.clean_examples(Q.example_lines('examples'))}, chr(10)) AS examples_text FROM scheme_rows""",
          ("scheme_rows",))
def q_clean_examples(spark, sf):
    lines = S.example_lines(F.col("examples"))
    return rows(spark, sf).select("scheme_id", "ordinal", F.size(lines).alias("n_examples"),
                                  F.array_join(S.clean_examples(lines), "\n").alias("examples_text"))


@register("clean_values", f"""
SELECT scheme_id, ordinal, {Q.clean_values('values_text')} AS values_fixed,
  {Q.clean_values('values_text', 'current')} AS values_current FROM scheme_rows""", ("scheme_rows",))
def q_clean_values(spark, sf):
    return rows(spark, sf).select("scheme_id", "ordinal", S.clean_values(F.col("values_text")).alias("values_fixed"),
                                  S.clean_values(F.col("values_text"), "current").alias("values_current"))


@register("normalise_scheme", f"SELECT {_SCHEME_OUT} FROM o_scheme", ("o_scheme",))
def q_normalise_scheme(spark, sf):
    return _scheme_out(normalised(spark, sf))


@register("drop_derived", "SELECT scheme_id, ordinal, key FROM o_scheme WHERE NOT starts_with(key, '_DERIVED_')",
          ("o_scheme",))
def q_drop_derived(spark, sf):
    return OS.drop_derived(normalised(spark, sf)).select("scheme_id", "ordinal", "key")


# A scheme as edited by hand: missing names, keys, criteria, examples and values, and a key given twice.
_EDITED = ["scheme_id", "ordinal", "CASE WHEN ordinal % 17 = 3 THEN 'Doppelt' WHEN ordinal % 41 = 4 THEN NULL ELSE key END AS key",
           "CASE WHEN ordinal % 19 = 5 THEN NULL ELSE display_name END AS display_name",
           "CASE WHEN ordinal % 13 = 1 THEN NULL ELSE criteria END AS criteria",
           "CASE WHEN ordinal % 13 = 2 THEN NULL ELSE examples END AS examples",
           "CASE WHEN ordinal % 13 = 3 THEN NULL ELSE values_text END AS values_text", "condition_problem"]


@register("scheme_violations", f"""
WITH e AS (SELECT {', '.join(_EDITED)} FROM o_scheme),
 n AS (SELECT *, {Q.bare_name("coalesce(display_name, key, '')")} AS bare FROM e)
SELECT scheme_id, ordinal, 'duplicate_name' AS rule FROM n a WHERE bare <> ''
  AND EXISTS (SELECT 1 FROM n b WHERE b.scheme_id = a.scheme_id AND b.bare = a.bare AND b.ordinal < a.ordinal)
UNION ALL SELECT scheme_id, ordinal, 'key_collision' FROM e a
  WHERE EXISTS (SELECT 1 FROM e b WHERE b.scheme_id = a.scheme_id AND b.key = a.key AND b.key <> '' AND b.ordinal < a.ordinal)
UNION ALL SELECT scheme_id, ordinal, 'missing_criteria' FROM e WHERE criteria IS NULL
UNION ALL SELECT scheme_id, ordinal, 'missing_examples' FROM e WHERE examples IS NULL
UNION ALL SELECT scheme_id, ordinal, 'missing_values' FROM e WHERE values_text IS NULL
UNION ALL SELECT scheme_id, ordinal, condition_problem FROM e WHERE condition_problem IS NOT NULL""", ("o_scheme",))
def q_scheme_violations(spark, sf):
    return OS.scheme_violations(normalised(spark, sf).selectExpr(*_EDITED))


# Every format of the validator, and texts of none.
_FORMATS = ["Ja (1), Nein (0)", "offen", "Hochschule (1), Anbieter (2), Uni (3)", "Haus (1), Hof (2), -99", "SoSe24; WiSe24/25; -99",
            "A; B; C; -99", "Lehre und Forschung; Praxis; -99", "eins, zwei", "wenn 2.1 = 1", "-99", "eins,zwei", "", "'offen'", "A; -99", "x, , y"]
_FORMAT_SQL = "CASE ordinal % {n} {whens} ELSE values_text END".format(
    n=len(_FORMATS) + 1, whens=" ".join(f"WHEN {i} THEN '{v.replace(chr(39), chr(39) * 2)}'" for i, v in enumerate(_FORMATS)))


@register("values_format", f"SELECT scheme_id, ordinal, {Q.values_format('values_text')} AS format FROM ("
          f"SELECT scheme_id, ordinal, {_FORMAT_SQL} AS values_text FROM o_scheme)", ("o_scheme",))
def q_values_format(spark, sf):
    df = normalised(spark, sf).selectExpr("scheme_id", "ordinal", f"{_FORMAT_SQL} AS values_text")
    return df.select("scheme_id", "ordinal", S.values_format(F.col("values_text")).alias("format"))


@register("scheme_aliases", """
SELECT scheme_id, alias, arg_max(key, pos) AS key FROM (
  SELECT scheme_id, key AS alias, key, ordinal * 2 AS pos FROM o_scheme
  UNION ALL SELECT scheme_id, simplified_name, key, ordinal * 2 + 1 FROM o_scheme WHERE simplified_name IS NOT NULL)
GROUP BY scheme_id, alias""", ("o_scheme",))
def q_scheme_aliases(spark, sf):
    return joins.scheme_aliases(normalised(spark, sf))


@register("assemble_scheme", f"SELECT {_SCHEME_OUT}, '1.0' AS version FROM o_scheme", ("o_scheme",))
def q_assemble_scheme(spark, sf):
    """Documents written per scheme (JSON lines, scheme order) and read back."""
    path = OS.assemble_scheme(normalised(spark, sf), scratch_path(spark, "schemes"))
    return _scheme_out(spark.read.schema(OS.CATEGORY_JSON_SCHEMA).json(path), "version")


# Positions of the categories in their documents, in place of the ordinals of the table they came from.
_DOC_OUT = _SCHEME_OUT.replace("ordinal,", "row_number() OVER (PARTITION BY scheme_id ORDER BY ordinal) - 1 AS ordinal,", 1)


@register("scheme_documents", f"SELECT {_DOC_OUT}, '1.0' AS version, CAST(NULL AS VARCHAR) AS problem FROM o_scheme", ("o_scheme",))
def q_scheme_documents(spark, sf):
    """Every scheme written as one nested document and loaded again: the same rows, in document order."""
    path = OS.assemble_documents(normalised(spark, sf), scratch_path(spark, "scheme_documents"))
    return _scheme_out(OS.load_scheme(spark, path), "version", "problem")


# Categories whose fields are of wrong types, or that are no objects at all, by their place in the scheme.
_BROKEN = {1: '"a text"', 2: '{"criteria": 5, "examples": [], "values": "offen"}', 3: '{"criteria": "c", "examples": "one", "values": "offen"}',
           4: '{"criteria": "c", "examples": ["e", 2], "values": ["a"]}', 5: '{"display_name": "7.7 Doppelt", "criteria": null, "examples": {}}',
           6: '["list"]', 7: '{"display_name": 12, "examples": null, "values": 1.5}', 8: '{"display_name": "8.1 Doppelt", "criteria": "[", "examples": [[1]], "values": "{"}'}
_BROKEN_RULES = {1: ["category_not_object"], 2: ["criteria_not_string"], 3: ["examples_not_list"], 4: ["values_not_string"],
                 5: ["criteria_not_string", "examples_not_list", "missing_values"], 6: ["category_not_object"],
                 7: ["missing_criteria", "examples_not_list", "values_not_string", "display_name_not_string"], 8: []}


@register("scheme_document_violations", f"""
WITH e AS (SELECT scheme_id, ordinal, ordinal % 11 AS m FROM o_scheme)
SELECT scheme_id, pos AS ordinal, unnest(CASE m {' '.join(f"WHEN {m} THEN {r}::VARCHAR[]" for m, r in _BROKEN_RULES.items())} END) AS rule
FROM (SELECT *, row_number() OVER (PARTITION BY scheme_id ORDER BY ordinal) - 1 AS pos FROM e)
UNION ALL SELECT scheme_id, pos, 'duplicate_name' FROM (
  SELECT *, row_number() OVER (PARTITION BY scheme_id, m IN (5, 8) ORDER BY ordinal) AS nth FROM (
    SELECT *, row_number() OVER (PARTITION BY scheme_id ORDER BY ordinal) - 1 AS pos FROM e)) WHERE m IN (5, 8) AND nth > 1""", ("o_scheme",))
def q_scheme_document_violations(spark, sf):
    """Violations of documents as users write them: wrong types, missing fields, names given twice."""
    raw = F.create_map(*[F.lit(x) for pair in _BROKEN.items() for x in pair])[(F.col("ordinal") % 11).cast("int")]
    sound = F.concat(F.lit('{"criteria": "c", "examples": [], "values": "offen", "display_name": "'), "ordinal", F.lit('"}'))
    one = F.concat(F.lit('"k'), "ordinal", F.lit('": '), F.coalesce(raw, sound))
    docs = normalised(spark, sf).groupBy("scheme_id").agg(F.array_sort(F.collect_list(F.struct("ordinal", one.alias("c")))).alias("c"))
    text = F.concat(F.lit('{"coding_scheme": {"version": "1.0", "categories": {'), F.array_join(F.transform("c", lambda c: c["c"]), ",\n"), F.lit("}}}"))
    return OS.scheme_violations(scheme_documents.categories(docs.select("scheme_id", text.alias("document"))))


@register("build_scheme", f"""
SELECT scheme_id, ordinal, key, key AS display_name, {Q.simplify_name('key')} AS simplified_name, {Q.clean_criteria('criteria')} AS criteria,
  array_to_string({Q.clean_examples('examples')}, chr(10)) AS examples_text, {Q.clean_values('values_text')} AS values_text,
  cond_type, reference, range_start, range_end, cond_value FROM o_scheme""", ("o_scheme",))
def q_build_scheme(spark, sf):
    """Import and fix steps chained; the violations are the query below."""
    return _scheme_out(OS.build_scheme(rows(spark, sf))[0])


@register("load_scheme", f"SELECT {_SCHEME_OUT}, CAST(NULL AS VARCHAR) AS problem FROM o_scheme", ("o_scheme",))
def q_load_scheme(spark, sf):
    path = OS.assemble_scheme(normalised(spark, sf), scratch_path(spark, "schemes"))
    return _scheme_out(OS.load_scheme(spark, path), "problem")
