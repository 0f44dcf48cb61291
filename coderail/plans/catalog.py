"""Registered queries: one Spark plan per operator and, where SQL can express it, a DuckDB oracle.

``QUERIES[name] = (fn(spark, sf_dir) -> DataFrame, oracle body SQL or None, CTE names it needs)``.
Oracle bodies read the fixture CTEs (same text as the Spark side) and the ``o_*`` CTEs below, which
restate the pipeline stages in SQL independently of the Spark operators.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import infer, joins, prep, prompt, results, validate
from ..sources import entries as src_entries
from ..sources import results_io
from ..session import scratch_path
from . import stages as P
from .fixtures import FIXTURES, TITLE, fixture, table
from .sqlfn import collapse, fence, guard, normalise, strip, validated

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[QueryFn, str | None, tuple[str, ...]]] = {}


def register(name: str, oracle: str | None = None, ctes: tuple[str, ...] = ()):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = (fn, oracle, ctes)
        return fn
    return deco


# ---------------------------------------------------------------- oracle-side pipeline stages (SQL)
_RENDER = "CASE WHEN examples_text = '' THEN '' ELSE '- ' || replace(examples_text, chr(10), chr(10) || '- ') END"
_SUFFIX = prompt.FORMAT_SUFFIX.replace("'", "''").replace("\n", "' || chr(10) || '")
_SYSTEM = prompt.SYSTEM_MESSAGE.replace("'", "''")


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def _prompt_sql() -> str:
    out = _sql_str(prompt.PROMPT_TEMPLATE)
    for ph, col in zip(prompt.PLACEHOLDERS, ["title", "description", "coalesce(display_name, category)", "criteria",
                                             "examples_rendered", "values_text"]):
        out = f"replace({out}, '{ph}', {col})"
    return out


CTES: dict[str, tuple[str, tuple[str, ...]]] = {name: (sql, ()) for name, sql in FIXTURES.items()}
CTES.update({
    "o_entries": (f"""
SELECT ordinal, title, description FROM (
  SELECT *, row_number() OVER (PARTITION BY title ORDER BY ordinal) AS rn FROM (
    SELECT ordinal, {strip('title')} AS title, {strip('description')} AS description FROM entries_raw)
  WHERE title IS NOT NULL AND description IS NOT NULL) WHERE rn = 1""", ("entries_raw",)),
    "o_codes": (f"SELECT ordinal, {strip('title')} AS title, human_code_quality, human_code_toxic FROM codes_raw",
                ("codes_raw",)),
    "o_cats": (f"""
SELECT s.cat_ordinal, t.key AS category, t.display_name, t.criteria, {_RENDER} AS examples_rendered, t.values_text
FROM (SELECT t.key, min(s.ordinal) AS cat_ordinal FROM selected s JOIN task_scheme t ON s.key IN (t.key, t.simplified_name)
      GROUP BY t.key) s JOIN task_scheme t ON s.key = t.key""",
               ("selected", "task_scheme")),
    "o_tasks": ("SELECT e.ordinal, e.title, e.description, c.* FROM o_entries e CROSS JOIN o_cats c",
                ("o_entries", "o_cats")),
    "o_prompts": (f"SELECT *, {_prompt_sql()} AS prompt FROM o_tasks", ("o_tasks",)),
    "o_guarded": (f"SELECT *, {guard('raw')} AS guard_error FROM responses_raw", ("responses_raw",)),
    "o_resolved": (f"""
SELECT k.doc_id, k.category, f.attempt, f.response, CASE WHEN f.attempt IS NULL THEN k.last_error END AS error,
       k.n_attempts
FROM (SELECT doc_id, category, max(attempt) AS n_attempts, arg_max(guard_error, attempt) AS last_error,
        min(attempt) FILTER (WHERE guard_error IS NULL) AS ok_attempt FROM o_guarded GROUP BY doc_id, category) k
LEFT JOIN (SELECT doc_id, category, attempt, {fence('raw')} AS response FROM o_guarded) f
  ON f.doc_id = k.doc_id AND f.category = k.category AND f.attempt = k.ok_attempt""", ("o_guarded",)),
    "o_coded": ("SELECT ordinal, cat_ordinal, title, description, category, ai_code, confidence, confidence_level, "
                "reasoning, outcome FROM (" + validated("""(SELECT e.ordinal, c.cat_ordinal, e.title, e.description,
       r.category, r.response FROM o_resolved r JOIN o_entries e ON r.doc_id = e.ordinal
       JOIN o_cats c ON r.category = c.category WHERE r.error IS NULL)""") + ")",
                ("o_resolved", "o_entries", "o_cats")),
    "o_merged": ("""
SELECT e.ordinal, e.title, e.description, coalesce(c.human_code_quality, '0') AS human_code_quality,
       coalesce(c.human_code_toxic, '0') AS human_code_toxic
FROM o_entries e LEFT JOIN o_codes c ON e.title IS NOT DISTINCT FROM c.title""", ("o_entries", "o_codes")),
    "o_merged_tasks": (f"""
SELECT title, description FROM (SELECT {strip('title')} AS title, {strip('description')} AS description
  FROM entries_raw) WHERE title IS NOT NULL AND description IS NOT NULL""", ("entries_raw",)),
    "o_codes_prepared": ("""
SELECT title, CASE WHEN human_code_quality IN ('0', '1') THEN human_code_quality WHEN human_code_quality IS NOT NULL THEN '0' END
  AS human_code_quality, human_code_toxic
FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY ordinal) AS rn FROM o_codes WHERE title IS NOT NULL) WHERE rn = 1""",
                         ("o_codes",)),
    "o_human": ("""
SELECT e.ordinal, e.title, k.category, CASE k.category WHEN 'quality' THEN coalesce(c.human_code_quality, '0')
  WHEN 'toxic' THEN coalesce(c.human_code_toxic, '0') ELSE '0' END AS human_code
FROM o_entries e LEFT JOIN o_codes_prepared c ON e.title = c.title
CROSS JOIN (VALUES ('quality'), ('toxic'), ('length')) AS k(category)""", ("o_entries", "o_codes_prepared")),
    "o_paired": (f"""
SELECT c.ordinal, c.category, {normalise('c.ai_code')} AS ai_code, c.confidence, c.title, h.human_code
FROM o_coded c JOIN o_human h ON c.ordinal = h.ordinal AND c.category = h.category""", ("o_coded", "o_human")),
})


def oracle_text(name: str) -> str | None:
    _, body, ctes = QUERIES[name]
    if body is None:
        return None
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for c in ctes:
        visit(c)
    body = body.strip()
    if not order:
        return body
    head = "WITH " + ",\n".join(f"{n} AS ({CTES[n][0]})" for n in order)
    if body[:15].upper() == "WITH RECURSIVE ":
        return head.replace("WITH ", "WITH RECURSIVE ", 1) + ",\n" + body[15:]
    if body[:5].upper() == "WITH ":
        return head + ",\n" + body[5:]
    return head + "\n" + body


# ---------------------------------------------------------------- sources and sinks
@register("load_entries", "SELECT lang, description, ordinal, title FROM entries_raw", ("entries_raw",))
def q_load_entries(spark, sf):
    """CSV ingest by header: columns in another order, and one more, as users have them."""
    path = scratch_path(spark, "entries_csv")
    src_entries.write_csv(P.entries_raw(spark, sf).select("lang", "description", "ordinal", "title"), path)
    return src_entries.load_entries(spark, path, fmt="csv")


@register("csv_roundtrip", "SELECT ordinal, title, description FROM o_entries", ("o_entries",))
def q_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "prepared_csv")
    src_entries.write_csv(P.entries(spark, sf), path)
    return src_entries.load_entries(spark, path, fmt="csv")


@register("write_results", """
SELECT '20250519_144300' AS run_id, title, description, arg_max({N}, CASE WHEN category = 'quality' THEN {O} END) AS ai_quality,
  CAST(NULL AS VARCHAR) AS ai_toxic FROM o_coded GROUP BY title, description
UNION ALL
SELECT '20250519_151643', title, description, arg_max({N}, CASE WHEN category = 'quality' THEN {O} END),
  arg_max({N}, CASE WHEN category = 'toxic' THEN {O} END) FROM o_coded GROUP BY title, description"""
          .replace("{N}", normalise("ai_code")).replace("{O}", "ordinal * 1000 + cat_ordinal")
          .replace("title, description,", "title, " + collapse("description") + " AS description,"), ("o_coded",))
def q_write_results(spark, sf):
    """Two runs with different categories below one base path, the second written twice; all of it read back."""
    base = scratch_path(spark, "results")

    def stored(df, name):  # made once, read by every write
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    coded, texts = stored(P.coded(spark, sf).drop("description"), "results_coded"), stored(P.entries(spark, sf), "results_texts")
    results_io.write_results(results.wide_results(coded, ["quality"], entries=texts), base, "20250519_144300")
    for _ in range(2):
        results_io.write_results(results.wide_results(coded, ["quality", "toxic"], entries=texts), base, "20250519_151643")
    return results_io.read_results(spark, base).select("run_id", "title", "description", "ai_quality", "ai_toxic")


@register("latest_results", "SELECT * FROM runs WHERE run_id = (SELECT max(run_id) FROM runs)", ("runs",))
def q_latest_results(spark, sf):
    return results_io.latest_results(fixture(spark, sf, "runs"))


@register("latest_result_file", "SELECT * FROM runs WHERE run_id = (SELECT min(run_id) FROM runs)", ("runs",))
def q_latest_result_file(spark, sf):
    """The newest file over both names, not the last name: the first run is written after the last one, and the file
    written after it has no name of a result."""
    base, runs = scratch_path(spark, "result_files"), fixture(spark, sf, "runs")
    last, first = runs.select(F.max("run_id")).scalar(), runs.select(F.min("run_id")).scalar()
    runs.where(F.col("run_id") == last).write.parquet(f"{base}/results_2.parquet")
    runs.where(F.col("run_id") == first).write.parquet(f"{base}/ai_coded_results_1.parquet")
    runs.write.parquet(f"{base}/coded_3.parquet")
    return results_io.latest_result_file(spark, base)


# ---------------------------------------------------------------- preparation
@register("trim_columns", f"SELECT ordinal, {strip('title')} AS title, {strip('description')} AS description "
          "FROM entries_raw", ("entries_raw",))
def q_trim_columns(spark, sf):
    return prep.trim_columns(P.entries_raw(spark, sf), ["title", "description"]).select(
        "ordinal", "title", "description")


@register("drop_missing", "SELECT ordinal, title, description FROM entries_raw "
          "WHERE title IS NOT NULL AND description IS NOT NULL", ("entries_raw",))
def q_drop_missing(spark, sf):
    return prep.drop_missing(P.entries_raw(spark, sf), ["title", "description"]).select(
        "ordinal", "title", "description")


@register("dedupe_first", f"""
SELECT ordinal, title, lang FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY ordinal) AS rn
  FROM (SELECT ordinal, {strip('title')} AS title, lang FROM entries_raw)) WHERE rn = 1""", ("entries_raw",))
def q_dedupe_first(spark, sf):
    e = prep.trim_columns(P.entries_raw(spark, sf), ["title"]).select("ordinal", "title", "lang")
    return prep.dedupe_first(e, ["title"])


@register("prepare_entries", "SELECT * FROM o_entries", ("o_entries",))
def q_prepare_entries(spark, sf):
    return P.entries(spark, sf)


_RECODE_V = r"regexp_replace(human_code_quality, '^(-?\d+)\.0+$', '\1')"


@register("recode_invalid", f"""
SELECT ordinal, {strip('title')} AS title,
  CASE WHEN {_RECODE_V} IN ('0', '1') THEN {_RECODE_V} ELSE '0' END AS human_code,
  NOT coalesce({_RECODE_V} IN ('0', '1'), false) AS recoded
FROM codes_raw""", ("codes_raw",))
def q_recode_invalid(spark, sf):
    c = P.codes_wide(spark, sf).select("ordinal", "title", F.col("human_code_quality").alias("human_code"))
    return prep.recode_invalid(c, "human_code", flag="recoded")


@register("recode_report", f"""
SELECT count(*) AS n_rows, count(*) FILTER (WHERE NOT coalesce({_RECODE_V} IN ('0', '1'), false)) AS n_recoded
FROM codes_raw""", ("codes_raw",))
def q_recode_report(spark, sf):
    return prep.recode_report(fixture(spark, sf, "codes_raw").withColumnRenamed("human_code_quality", "human_code"))


@register("prepare_codes", f"""
SELECT ordinal, title, CASE WHEN {_RECODE_V.replace('human_code_quality', 'human_code')} IN ('0','1')
    THEN {_RECODE_V.replace('human_code_quality', 'human_code')} ELSE '0' END AS human_code
FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY ordinal) AS rn FROM (
  SELECT ordinal, {strip('title')} AS title, human_code_quality AS human_code FROM codes_raw)
  WHERE title IS NOT NULL AND human_code IS NOT NULL) WHERE rn = 1""", ("codes_raw",))
def q_prepare_codes(spark, sf):
    c = fixture(spark, sf, "codes_raw").withColumnRenamed("human_code_quality", "human_code")
    return prep.prepare_codes(c)


@register("entry_violations", """
SELECT ordinal, rule FROM (
  SELECT e.ordinal, 'title_not_string' AS rule FROM entries_raw e WHERE e.title IS NULL
  UNION ALL SELECT e.ordinal, 'description_not_string' FROM entries_raw e WHERE e.description IS NULL
  UNION ALL SELECT e.ordinal, 'human_code_pattern' FROM entries_raw e LEFT JOIN codes_raw c ON e.ordinal = c.ordinal
    WHERE NOT regexp_matches(coalesce(c.human_code_quality, '0'), '^[01]$'))""", ("entries_raw", "codes_raw"))
def q_entry_violations(spark, sf):
    c = fixture(spark, sf, "codes_raw").select("ordinal", F.col("human_code_quality").alias("human_code"))
    e = P.entries_raw(spark, sf).join(c, "ordinal", "left")
    return prep.entry_violations(e)


@register("sample_mode", """
SELECT scheme_id, ordinal, display_name FROM (
  SELECT *, row_number() OVER (PARTITION BY scheme_id ORDER BY ordinal) AS rn FROM scheme_rows) WHERE rn <= 2""",
          ("scheme_rows",))
def q_sample_mode(spark, sf):
    return prep.limit_categories(fixture(spark, sf, "scheme_rows"), 2).select("scheme_id", "ordinal", "display_name")


# ---------------------------------------------------------------- joins
@register("merge_codes", "SELECT * FROM o_merged", ("o_merged",))
def q_merge_codes(spark, sf):
    return joins.merge_codes(P.entries(spark, sf), P.codes_wide(spark, sf).drop("ordinal"))


@register("merge_prepared_codes", f"""
SELECT e.ordinal, e.title, e.description, c.ordinal AS ordinal_codes, coalesce(c.human_code, '0') AS human_code
FROM o_entries e LEFT JOIN (
  SELECT ordinal, title, CASE WHEN {_RECODE_V.replace('human_code_quality', 'human_code')} IN ('0', '1')
      THEN {_RECODE_V.replace('human_code_quality', 'human_code')} ELSE '0' END AS human_code
  FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY ordinal) AS rn FROM (
    SELECT ordinal, title, human_code_quality AS human_code FROM o_codes WHERE title IS NOT NULL AND human_code_quality IS NOT NULL))
  WHERE rn = 1) c ON e.title = c.title""", ("o_entries", "o_codes"))
def q_merge_prepared_codes(spark, sf):
    """The narrow prepared codes (P7) merged with the texts."""
    codes = prep.prepare_codes(fixture(spark, sf, "codes_raw").withColumnRenamed("human_code_quality", "human_code"))
    return joins.merge_codes(P.entries(spark, sf), codes)


@register("codes_long", "SELECT * FROM o_human", ("o_human",))
def q_codes_long(spark, sf):
    return P.human_long(spark, sf)


@register("build_tasks", "SELECT ordinal, cat_ordinal, category, title, display_name, values_text FROM o_tasks",
          ("o_tasks",))
def q_build_tasks(spark, sf):
    return P.tasks(spark, sf).select("ordinal", "cat_ordinal", "category", "title", "display_name", "values_text")


_WISHES = """SELECT event_id AS ordinal, CASE event_id % 4 WHEN 0 THEN 'quality' WHEN 1 THEN 'Beleidigung' ELSE category END
  AS key FROM runs"""


@register("unknown_categories", f"""
SELECT ordinal, key FROM ({_WISHES}) WHERE key NOT IN (SELECT key FROM task_scheme UNION ALL SELECT simplified_name FROM task_scheme)""",
          ("runs", "task_scheme"))
def q_unknown_categories(spark, sf):
    """Wishes by key, by simplified name, and by names the scheme does not have."""
    key = (F.when(F.col("event_id") % 4 == 0, "quality").when(F.col("event_id") % 4 == 1, "Beleidigung").otherwise(F.col("category")))
    sel = fixture(spark, sf, "runs").select(F.col("event_id").alias("ordinal"), key.alias("key"))
    return joins.unknown_categories(sel, P.task_scheme(spark, sf))


@register("title_mismatch", """
SELECT 'missing_in_codes' AS side, title FROM (SELECT title FROM o_entries EXCEPT SELECT title FROM o_codes)
UNION ALL SELECT 'extra_in_codes', title FROM (SELECT title FROM o_codes EXCEPT SELECT title FROM o_entries)""",
          ("o_entries", "o_codes"))
def q_title_mismatch(spark, sf):
    return joins.title_mismatch(P.entries(spark, sf), P.codes_wide(spark, sf))


_STORE_SQL = """
SELECT DISTINCT sha256(p.prompt) AS prompt_hash FROM o_prompts p JOIN o_resolved r
  ON r.doc_id = p.ordinal AND r.category = p.category WHERE r.error IS NULL"""


@register("pending_tasks", f"""
SELECT ordinal, category, sha256(prompt) AS prompt_hash FROM o_prompts
WHERE sha256(prompt) NOT IN ({_STORE_SQL})""", ("o_prompts", "o_resolved"))
def q_pending_tasks(spark, sf):
    pr = P.prompts(spark, sf).withColumn("model", F.lit("rule-scorer")).withColumn("temperature", F.lit(0.0))
    good, _ = infer.split_failures(P.resolved(spark, sf))
    stored = (good.select(F.col("doc_id").alias("ordinal"), "category")
              .join(pr.select("ordinal", "category", "prompt_hash", "model", "temperature"),
                    ["ordinal", "category"], "inner"))
    return joins.pending_tasks(pr, stored).select("ordinal", "category", "prompt_hash")


# ---------------------------------------------------------------- prompts
@register("construct_prompt", "SELECT ordinal, category, prompt FROM o_prompts", ("o_prompts",))
def q_construct_prompt(spark, sf):
    return P.prompts(spark, sf).select("ordinal", "category", "prompt")


@register("render_examples", """
SELECT scheme_id, ordinal, array_to_string(list_transform(
  list_filter(string_split(examples, chr(10)), lambda l: trim(l) <> ''), lambda x: '- ' || x), chr(10)) AS rendered
FROM scheme_rows""", ("scheme_rows",))
def q_render_examples(spark, sf):
    s = fixture(spark, sf, "scheme_rows")
    lines = F.filter(F.split(F.col("examples"), "\n", -1), lambda l: F.trim(l) != "")
    return s.select("scheme_id", "ordinal", prompt.render_examples(lines).alias("rendered"))


@register("build_messages", f"""
SELECT ordinal, category, to_json([{{'role': 'system', 'content': '{_SYSTEM}'}},
  {{'role': 'user', 'content': prompt || '{_SUFFIX}'}}])::VARCHAR AS messages_json FROM o_prompts""", ("o_prompts",))
def q_build_messages(spark, sf):
    m = prompt.build_messages(P.prompts(spark, sf))
    return m.select("ordinal", "category", F.to_json("messages").alias("messages_json"))


@register("extract_prompt_fields", """
SELECT ordinal, category,
  coalesce(split_part(list_filter(string_split(prompt, chr(10)), lambda l: contains(l, 'Titel: '))[1], 'Titel: ', 2),
           'No title found') AS prompt_title,
  coalesce(split_part(split_part(list_filter(string_split(prompt, chr(10)),
           lambda l: contains(l, '"category": "'))[1], 'category": "', 2), '"', 1), 'No category found')
    AS prompt_category
FROM o_prompts""", ("o_prompts",))
def q_extract_prompt_fields(spark, sf):
    return prompt.extract_prompt_fields(P.prompts(spark, sf)).select(
        "ordinal", "category", "prompt_title", "prompt_category")


# ---------------------------------------------------------------- inference
_N = "length(description)"
_RULE_V = (f"CASE WHEN category = 'length' THEN CASE WHEN {_N} >= 2000 THEN '1' ELSE '0' END "
           f"WHEN category = 'quality' THEN CASE WHEN contains(description, chr(10)) THEN '1' ELSE '0' END "
           f"ELSE CASE WHEN {_N} % 2 = 0 THEN '1' ELSE '0' END END")
_RULE_RESPONSE = (f"'{{\"value\": \"' || {_RULE_V} || '\", \"confidence\": 0.' || lpad(CAST({_N} % 100 AS VARCHAR), 2, '0')"
                  f" || ', \"reasoning\": \"rule ' || category || ' n=' || CAST({_N} AS VARCHAR) || '\"}}'")


@register("classify_rules", f"""
SELECT ordinal, cat_ordinal, category, title, sha256(prompt) AS prompt_hash, 'rule-scorer' AS model,
  CAST(0.0 AS DOUBLE) AS temperature, CAST(1 AS INTEGER) AS attempts, {_RULE_RESPONSE} AS response,
  CAST(NULL AS VARCHAR) AS error
FROM o_prompts""", ("o_prompts",))
def q_classify_rules(spark, sf):
    return infer.classify(P.prompts(spark, sf, num_partitions=8), infer.rule_scorer)


@register("classify_retry", f"""
SELECT ordinal, category,
  CAST(CASE WHEN {_N} % 7 = 0 THEN 3 ELSE {_N} % 3 + 1 END AS INTEGER) AS attempts,
  CASE WHEN {_N} % 7 = 0 THEN NULL ELSE {_RULE_RESPONSE} END AS response,
  CASE WHEN {_N} % 7 = 0 THEN 'ConnectionError: model unavailable' END AS error
FROM o_prompts""", ("o_prompts",))
def q_classify_retry(spark, sf):
    waits = []
    out = infer.classify(P.prompts(spark, sf, num_partitions=8), infer.flaky_scorer, sleep=waits.append)
    return out.select("ordinal", "category", "attempts", "response", "error")


@register("guard_response", f"SELECT doc_id, category, attempt, {guard('raw')} AS guard_error FROM responses_raw",
          ("responses_raw",))
def q_guard_response(spark, sf):
    return infer.guard_responses(fixture(spark, sf, "responses_raw")).select(
        "doc_id", "category", "attempt", "guard_error")


@register("resolve_attempts", "SELECT * FROM o_resolved", ("o_resolved",))
def q_resolve_attempts(spark, sf):
    return P.resolved(spark, sf)


@register("failed_pairs", "SELECT doc_id, category, error, n_attempts FROM o_resolved WHERE error IS NOT NULL",
          ("o_resolved",))
def q_failed_pairs(spark, sf):
    _, bad = infer.split_failures(P.resolved(spark, sf))
    return bad.select("doc_id", "category", "error", "n_attempts")


# ---------------------------------------------------------------- validation (V1-V9)
def _validated_raw(spark, sf):
    return validate.validate_responses(fixture(spark, sf, "responses_raw"), "raw")


_V_ALL = "(" + validated("responses_raw", "raw") + ")"


@register("strip_fence", f"SELECT doc_id, category, attempt, {fence('raw')} AS clean FROM responses_raw",
          ("responses_raw",))
def q_strip_fence(spark, sf):
    from ..functions.response import strip_fence
    return fixture(spark, sf, "responses_raw").select("doc_id", "category", "attempt",
                                                       strip_fence(F.col("raw")).alias("clean"))


@register("parse_response", f"""
SELECT doc_id, category, attempt,
  CASE json_type(js) WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'VARCHAR' THEN 'string'
    ELSE CASE WHEN js IS NULL THEN NULL ELSE 'scalar' END END AS kind
FROM (SELECT *, CASE WHEN json_valid(c) THEN c END AS js FROM (
  SELECT doc_id, category, attempt, {fence('raw')} AS c FROM responses_raw))""", ("responses_raw",))
def q_parse_response(spark, sf):
    from ..functions.response import json_kind, strip_fence
    return fixture(spark, sf, "responses_raw").select("doc_id", "category", "attempt",
                                                       json_kind(strip_fence(F.col("raw"))).alias("kind"))


@register("missing_fields", f"""
SELECT doc_id, category, attempt, reasoning AS message FROM {_V_ALL} v
WHERE outcome = 'missing_fields'""", ("responses_raw",))
def q_missing_fields(spark, sf):
    return _validated_raw(spark, sf).filter(F.col("outcome") == "missing_fields").select(
        "doc_id", "category", "attempt", F.col("reasoning").alias("message"))


@register("coerce_confidence", f"SELECT doc_id, category, attempt, confidence, outcome FROM {_V_ALL} v",
          ("responses_raw",))
def q_coerce_confidence(spark, sf):
    return _validated_raw(spark, sf).select("doc_id", "category", "attempt", "confidence", "outcome")


@register("confidence_level", f"SELECT doc_id, category, attempt, confidence_level FROM {_V_ALL} v",
          ("responses_raw",))
def q_confidence_level(spark, sf):
    return _validated_raw(spark, sf).select("doc_id", "category", "attempt", "confidence_level")


@register("normalise_code", f"SELECT doc_id, category, attempt, ai_code, {normalise('ai_code')} AS code FROM {_V_ALL} v",
          ("responses_raw",))
def q_normalise_code(spark, sf):
    from ..functions.text import normalise_code
    return _validated_raw(spark, sf).select("doc_id", "category", "attempt", "ai_code",
                                            normalise_code(F.col("ai_code")).alias("code"))


@register("validate_responses", f"""
SELECT doc_id, category, attempt, ai_code, confidence, confidence_level, reasoning, outcome FROM {_V_ALL} v""",
          ("responses_raw",))
def q_validate_responses(spark, sf):
    return _validated_raw(spark, sf).select("doc_id", "category", "attempt", "ai_code", "confidence",
                                            "confidence_level", "reasoning", "outcome")


@register("invalid_answers_raw", f"""
SELECT doc_id, category, attempt, CASE WHEN outcome = 'invalid_json' THEN coalesce(raw, '') ELSE ai_code END AS ai_code, outcome
FROM {_V_ALL} v""", ("responses_raw",))
def q_invalid_answers_raw(spark, sf):
    """``on_invalid='raw'``: an answer that is no JSON becomes the code itself."""
    out = validate.validate_responses(fixture(spark, sf, "responses_raw"), "raw", on_invalid="raw")
    return out.select("doc_id", "category", "attempt", "ai_code", "outcome")


@register("invalid_answers_drop", f"SELECT doc_id, category, attempt, ai_code, outcome FROM {_V_ALL} v WHERE outcome <> 'invalid_json'",
          ("responses_raw",))
def q_invalid_answers_drop(spark, sf):
    """``on_invalid='drop'``: no row for an answer that is no JSON."""
    out = validate.validate_responses(fixture(spark, sf, "responses_raw"), "raw", on_invalid="drop")
    return out.select("doc_id", "category", "attempt", "ai_code", "outcome")


@register("validation_report", f"SELECT category, outcome, count(*) AS n FROM {_V_ALL} v GROUP BY ALL",
          ("responses_raw",))
def q_validation_report(spark, sf):
    return validate.validation_report(_validated_raw(spark, sf))


# ---------------------------------------------------------------- results
def _wide_sql(cats):
    cats = sorted(cats)
    ordv = "ordinal * 1000 + cat_ordinal"
    parts = [f"{collapse('arg_min(description, ' + ordv + ')')} AS description"]
    parts += [f"arg_max({normalise('ai_code')}, CASE WHEN category = '{c}' THEN {ordv} END) AS ai_{c}" for c in cats]
    parts += [f"arg_max(printf('%.2f', confidence), CASE WHEN category = '{c}' THEN {ordv} END) AS confidence_{c}"
              for c in cats]
    parts += [f"arg_max(reasoning, CASE WHEN category = '{c}' THEN {ordv} END) AS reasoning_{c}" for c in cats]
    return "SELECT title, " + ", ".join(parts) + " FROM o_coded GROUP BY title"


@register("wide_results", _wide_sql(P.CATEGORIES), ("o_coded",))
def q_wide_results(spark, sf):
    return results.wide_results(P.coded(spark, sf), P.CATEGORIES, entries=P.entries(spark, sf))


@register("title_collisions", """
SELECT title, count(*) AS n_rows FROM o_merged_tasks GROUP BY title
HAVING min(sha256(description)) <> max(sha256(description))""", ("o_merged_tasks",))
def q_title_collisions(spark, sf):
    """Stripped texts before the first-title-wins dedupe: titles that carry differing descriptions
    (the dedupe and the wide table keep only the first of them)."""
    raw = prep.drop_missing(prep.trim_columns(P.entries_raw(spark, sf), ["title", "description"]),
                            ["title", "description"])
    return results.title_collisions(raw.select("title", "description"))


@register("collapse_whitespace", f"SELECT doc_id, {collapse('text')} AS text FROM documents")
def q_collapse_whitespace(spark, sf):
    from ..functions.text import collapse_whitespace
    return table(spark, sf, "documents").select("doc_id", collapse_whitespace(F.col("text")).alias("text"))


@register("format_confidence", "SELECT ordinal, category, printf('%.2f', confidence) AS confidence_text FROM o_coded",
          ("o_coded",))
def q_format_confidence(spark, sf):
    from ..functions.text import format_2dp
    return P.coded(spark, sf).select("ordinal", "category", format_2dp(F.col("confidence")).alias("confidence_text"))


@register("category_metrics", """
SELECT category, count(*) AS total_samples, count(*) FILTER (WHERE ai_code = '1') AS positive_classifications,
  round(avg(confidence), 4) AS average_confidence FROM o_coded GROUP BY category""", ("o_coded",))
def q_category_metrics(spark, sf):
    return results.category_metrics(P.coded(spark, sf))


@register("category_metrics_normalised", f"""
SELECT category, count(*) AS total_samples, count(*) FILTER (WHERE {normalise('ai_code')} = '1')
  AS positive_classifications, round(avg(confidence), 4) AS average_confidence FROM o_coded GROUP BY category""",
          ("o_coded",))
def q_category_metrics_normalised(spark, sf):
    return results.category_metrics(P.coded(spark, sf), normalised=True)


@register("overall_metrics", """
SELECT category, CASE WHEN grouping(category) = 1 THEN 'overall' ELSE 'category' END AS scope,
  count(*) AS total_samples, count(*) FILTER (WHERE ai_code = '1') AS positive_classifications,
  round(avg(confidence), 4) AS average_confidence FROM o_coded GROUP BY ROLLUP (category)""", ("o_coded",))
def q_overall_metrics(spark, sf):
    return results.overall_metrics(P.coded(spark, sf))


@register("run_progress", """
SELECT coalesce(category, '_overall') AS category, count(*) AS n_tasks, count(d.ordinal) AS n_done,
  CAST(CASE WHEN count(*) = 0 THEN 0 ELSE floor(count(d.ordinal) * 100 / count(*)) END AS BIGINT) AS pct_done
FROM (SELECT t.category, d.ordinal FROM o_tasks t LEFT JOIN (SELECT DISTINCT ordinal, category FROM o_coded) d
      ON t.ordinal = d.ordinal AND t.category = d.category) d
GROUP BY ROLLUP (category)""", ("o_tasks", "o_coded"))
def q_run_progress(spark, sf):
    return results.run_progress(P.tasks(spark, sf), P.coded(spark, sf))


@register("confusion_counts", """
SELECT category, human_code, ai_code, CAST(sum(n) AS BIGINT) AS n FROM (
  SELECT category, human_code, ai_code, 1 AS n FROM o_paired
  UNION ALL SELECT DISTINCT p.category, h.c, a.c, 0 FROM o_paired p CROSS JOIN (VALUES ('0'), ('1')) AS h(c)
    CROSS JOIN (VALUES ('0'), ('1')) AS a(c)) GROUP BY ALL""", ("o_paired",))
def q_confusion_counts(spark, sf):
    return results.confusion_counts(results.paired_codes(P.coded(spark, sf), P.human_long(spark, sf)))


_KAPPA = """
WITH cells AS (SELECT category, human_code, ai_code, count(*) AS n FROM o_paired GROUP BY ALL),
 pc AS (SELECT category, sum(n) AS n_pairs, sum(CASE WHEN human_code = ai_code THEN n ELSE 0 END) AS n_agree
        FROM cells GROUP BY category),
 h AS (SELECT category, human_code AS code, sum(n) AS nh FROM cells GROUP BY ALL),
 a AS (SELECT category, ai_code AS code, sum(n) AS na FROM cells GROUP BY ALL),
 m AS (SELECT h.category, sum(nh * na) AS hxa FROM h JOIN a ON h.category = a.category AND h.code = a.code
       GROUP BY h.category),
 k AS (SELECT pc.category, pc.n_pairs, pc.n_agree / CAST(pc.n_pairs AS DOUBLE) AS po,
         coalesce(m.hxa, 0) / (CAST(pc.n_pairs AS DOUBLE) * pc.n_pairs) AS pe
       FROM pc LEFT JOIN m ON pc.category = m.category)
SELECT category, CAST(n_pairs AS BIGINT) AS n_pairs, round(po, 4) AS observed, round(pe, 4) AS expected,
  round(CASE WHEN pe = 1 THEN NULL ELSE (po - pe) / (1 - pe) END, 4) AS kappa FROM k"""


@register("agreement_kappa", _KAPPA, ("o_paired",))
def q_agreement_kappa(spark, sf):
    return results.agreement_kappa(results.paired_codes(P.coded(spark, sf), P.human_long(spark, sf)))


@register("confidence_distribution", """
SELECT category, count(*) FILTER (WHERE confidence_level = 'low') AS n_low,
  count(*) FILTER (WHERE confidence_level = 'medium') AS n_medium,
  count(*) FILTER (WHERE confidence_level = 'high') AS n_high FROM o_coded GROUP BY category""", ("o_coded",))
def q_confidence_distribution(spark, sf):
    return results.confidence_distribution(P.coded(spark, sf))


@register("review_queue", """
SELECT category, rank, ordinal, title, confidence, ai_code, human_code FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY category ORDER BY confidence, title, ordinal) AS BIGINT) AS rank
  FROM o_paired WHERE confidence < 0.33 OR ai_code <> human_code) WHERE rank <= 5""", ("o_paired",))
def q_review_queue(spark, sf):
    return results.review_queue(results.paired_codes(P.coded(spark, sf), P.human_long(spark, sf)), k=5)


# ---------------------------------------------------------------- streaming (incremental coding)
# The entries_raw fixture's projection, applied to the streamed documents.
_STREAM_TEXTS = [
    "doc_id AS ordinal",
    f"CASE WHEN doc_id % 50 = 7 THEN NULL WHEN doc_id % 50 = 8 THEN '   ' ELSE concat('  ', {TITLE}, ' ') END AS title",
    "CASE WHEN doc_id % 40 = 3 THEN NULL ELSE text END AS description",
]


@register("stream_classify", f"""
SELECT ordinal, category, sha256('{_SYSTEM}' || chr(10) || prompt || '{_SUFFIX}') AS prompt_hash, {_RULE_RESPONSE} AS response
FROM o_prompts""", ("o_prompts",))
def q_stream_classify(spark, sf):
    """The documents table streamed (file source, available-now trigger) through incremental coding;
    the result is the response store it fills."""
    from ..streaming import incremental
    base = scratch_path(spark, "stream")
    q = incremental.start(
        spark, f"{sf.rstrip('/')}/{{documents.parquet}}",  # a glob: the table may be one file or a folder of part files
        schema="doc_id bigint, text string, lang string, source string, n_chars bigint",
        selected=fixture(spark, sf, "selected"), scheme=P.task_scheme(spark, sf),
        infer_fn=infer.rule_scorer, store=f"{base}/store", checkpoint=f"{base}/checkpoint",
        transform=lambda df: df.selectExpr(*_STREAM_TEXTS))
    q.awaitTermination()
    return incremental.stored_responses(spark, f"{base}/store").select("ordinal", "category", "prompt_hash", "response")


@register("stream_retry", f"""
SELECT ordinal, category, {_RULE_RESPONSE} AS response, CAST(1 AS INTEGER) AS batch_id FROM o_prompts""", ("o_prompts",))
def q_stream_retry(spark, sf):
    """Batch 0 fails every call of its one category; batch 1 brings the same texts and all categories: the failed
    pairs and the new categories of the known texts are answered there, each once."""
    from ..streaming import incremental
    store, texts = scratch_path(spark, "stream_retry"), P.entries_raw(spark, sf)

    def unavailable(request):
        raise ConnectionError("model unavailable")
    common = dict(scheme=P.task_scheme(spark, sf), store=store, model="rule-scorer", temperature=0.0, backoff=0.0)
    one = spark.createDataFrame([(1, "quality")], "ordinal int, key string")
    incremental.code_batch(texts, 0, selected=one, infer_fn=unavailable, **common)
    incremental.code_batch(texts, 1, selected=fixture(spark, sf, "selected"), infer_fn=infer.rule_scorer, **common)
    return (incremental.stored_responses(spark, store).filter(F.col("error").isNull())
            .select("ordinal", "category", "response", F.col("batch_id").cast("int").alias("batch_id")))


@register("stream_selection", f"""
SELECT ordinal, category, {_RULE_RESPONSE} AS response, CAST(CASE WHEN batch = 1 AND category = 'toxic' THEN 2 ELSE batch END AS INTEGER) AS batch_id
FROM (SELECT *, CASE WHEN ordinal % 3 = 0 THEN 0 WHEN ordinal % 3 = 1 THEN 1 ELSE 2 END AS batch FROM o_prompts)
WHERE category IN ('quality', 'toxic')""", ("o_prompts",))
def q_stream_selection(spark, sf):
    """Three batches of texts; the second one's selection leaves a category out, which the third selects again: the texts
    that came between are asked for it then, and no pair is asked twice."""
    from ..streaming import incremental
    store, texts = scratch_path(spark, "stream_selection"), P.entries(spark, sf)
    common = dict(scheme=P.task_scheme(spark, sf), store=store, model="rule-scorer", temperature=0.0, backoff=0.0, infer_fn=infer.rule_scorer)
    for b, keys in enumerate((["quality", "toxic"], ["quality"], ["toxic", "quality"])):
        picked = spark.createDataFrame(list(enumerate(keys, 1)), "ordinal int, key string")
        incremental.code_batch(texts.where(F.col("ordinal") % 3 == b), b, selected=picked, **common)
    return incremental.stored_responses(spark, store).select("ordinal", "category", "response", F.col("batch_id").cast("int").alias("batch_id"))


# ---------------------------------------------------------------- one batch run with its response store
@register("coding_run", f"""
SELECT category, count(*) AS total_samples,
  count(*) FILTER (WHERE ({_RULE_V}) = '1') AS positive_classifications,
  round(avg(CAST('0.' || lpad(CAST({_N} % 100 AS VARCHAR), 2, '0') AS DOUBLE)), 4) AS average_confidence
FROM o_prompts GROUP BY category""", ("o_prompts",))
def q_coding_run(spark, sf):
    """Texts coded end to end (rule scorer as the model), answers materialised in the store."""
    from .run import coding_run
    out = coding_run(spark, P.entries_raw(spark, sf), fixture(spark, sf, "selected"), P.task_scheme(spark, sf),
                     infer.rule_scorer, scratch_path(spark, "run"), P.CATEGORIES, num_partitions=8)
    return out["metrics"]


@register("coding_run_restart", f"""
SELECT category, count(*) AS n_coded, count(*) AS n_answers, count(*) FILTER ({_N} % 7 = 0) AS n_failed_first,
  CAST(0 AS BIGINT) AS n_paid_twice
FROM o_prompts GROUP BY category""", ("o_prompts",))
def q_coding_run_restart(spark, sf):
    """A run that fails some pairs, then twice again under the same id: the store keeps every answer, the second start
    asks for the failed pairs alone, the third for nothing, and the coded pairs are whole each time."""
    from .run import coding_run
    args = (P.entries_raw(spark, sf), fixture(spark, sf, "selected"), P.task_scheme(spark, sf))
    base = scratch_path(spark, "restart")
    for scorer in (infer.flaky_scorer, infer.rule_scorer, infer.rule_scorer):
        out = coding_run(spark, *args, scorer, base, P.CATEGORIES, num_partitions=8, backoff=0.0, run_id="restart", waves=2)
    ok = F.col("error").isNull()
    answers = out["new_answers"].groupBy("request_id").agg(F.count_if(ok).alias("n"), F.count_if(~ok).alias("failed"))
    pairs = spark.read.parquet(f"{base}/pairs/run_id=restart").join(answers, "request_id").groupBy("category").agg(
        F.sum("n").alias("n_answers"), F.sum("failed").alias("n_failed_first"), F.count_if(F.col("n") > 1).alias("n_paid_twice"))
    return out["coded"].groupBy("category").agg(F.count("*").alias("n_coded")).join(pairs, "category")


@register("run_agreement", _KAPPA.replace("FROM o_paired", f"""FROM (SELECT p.category, h.human_code, {_RULE_V.replace('category =', 'p.category =')
          } AS ai_code FROM o_prompts p JOIN o_human h ON p.ordinal = h.ordinal AND p.category = h.category)"""), ("o_prompts", "o_human"))
def q_run_agreement(spark, sf):
    """A run with a user's template and human codes: its agreement per category."""
    from .run import coding_run
    out = coding_run(spark, P.entries_raw(spark, sf), fixture(spark, sf, "selected"), P.task_scheme(spark, sf),
                     infer.rule_scorer, scratch_path(spark, "run"), P.CATEGORIES, num_partitions=8, waves=2,
                     template="Titel: [title]\n[description]\n[criteria]: [values]?", human_codes=fixture(spark, sf, "codes_raw"))
    return out["agreement"]


@register("load_template", "SELECT ordinal, category, prompt FROM o_prompts", ("o_prompts",))
def q_load_template(spark, sf):
    """The template as a file (with the surrounding blank lines an editor leaves), read whole with
    ``spark.read.text(wholetext=True)``, stripped as the current pipeline does, then used for prompts."""
    path = scratch_path(spark, "template")
    spark.createDataFrame([("\n  " + prompt.PROMPT_TEMPLATE + "\n\n",)], "value string").coalesce(1) \
        .write.mode("overwrite").text(path)
    template = prompt.load_template(spark, path, strip=True)
    tasks = P.tasks(spark, sf)
    return prompt.construct_prompt(tasks, template=template).select("ordinal", "category", "prompt")


@register("sample_entries", """
SELECT ordinal, title, description FROM o_entries ORDER BY ordinal LIMIT 2""", ("o_entries",))
def q_sample_entries(spark, sf):
    """Sample mode for texts: the first two prepared texts in input order (the limit is the feature;
    planned as a top-k with a per-partition limit, not a global sort)."""
    return prep.limit_entries(P.entries(spark, sf), 2)
