"""Response parsing and validation (V1-V9): one projection, no Python worker.

Outcome of one answer (current pipeline semantics):
  invalid_json     -> value "0", confidence 0.0, low, reasoning "Error parsing JSON response"
  not an object    -> arrays/strings miss every field; numbers/literals: "Error validating response"
  missing_fields   -> value "0", confidence 0.0, low, "Missing required fields in response: [...]"
  bad_confidence   -> unparsable confidence becomes 0.0
  nan_confidence   -> NaN fails the [0, 1] bound -> "Error validating response"
  clamped          -> confidence outside [0, 1] clamped
  ok
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.response import (ANSWER_SCHEMA, REQUIRED_FIELDS, bare_boolean_confidence, bare_literals_quoted, document,
                                  json_trimmed, kind_of, overflowing_confidence, parse_float_text, py_list_text, strip_fence)
from ..functions.text import confidence_level

# Reasoning texts of the default record.
MSG_PARSE = "Error parsing JSON response"
MSG_MISSING = "Missing required fields in response: "
MSG_VALIDATE = "Error validating response"


def _c(c):
    return F.col(c) if isinstance(c, str) else c


OUTCOMES = ["ok", "clamped", "bad_confidence", "nan_confidence", "missing_fields", "not_object", "invalid_json"]


def _metrics_name(prefix: str) -> str:
    import uuid
    return f"coderail_{prefix}_{uuid.uuid4().hex[:12]}"


_TMP = ["_clean", "_t", "_doc", "_keys", "_j", "_kind", "_miss", "_conf", "_outcome"]


def validate_responses(df: DataFrame, raw: str = "response", keep_clean: bool = False,
                       observation=None, on_invalid: str = "default") -> DataFrame:
    """Adds ai_code, confidence, confidence_level, reasoning and outcome.

    ``on_invalid`` says what becomes of an answer that is no JSON: ``default`` (code "0"), ``raw`` (the
    answer itself as the code, confidence 0) or ``drop`` (no row). Nothing else ever drops a row.

    Built as a few stacked projections, each parsing once: the JSON text is scanned for keys,
    validity and fields once per row, and later stages only read the resulting columns (one giant
    expression would repeat the parses in every branch and outgrow whole-stage code generation).
    """
    t = df.withColumn("_clean", strip_fence(F.col(raw)))
    t = t.withColumn("_t", bare_literals_quoted(json_trimmed(F.col("_clean"))))
    t = t.withColumns({"_doc": document("_t"), "_j": F.from_json(F.col("_t"), ANSWER_SCHEMA)})
    # Keys are only listed for text that is no document; of a document each field is looked up.
    t = t.withColumn("_keys", F.when(F.col("_doc").isNull(), F.json_object_keys(F.col("_t"))))
    has = [F.when(F.col("_doc").isNotNull(), F.try_variant_get("_doc", f"$[0].{f}", "variant").isNotNull())
           .otherwise(F.coalesce(F.array_contains("_keys", f), F.lit(False))) for f in REQUIRED_FIELDS]
    said = F.col("_j.confidence")
    t = t.withColumns({"_kind": kind_of(F.col("_t"), F.col("_keys"), F.col("_doc").isNotNull()),
                       "_miss": F.array_compact(F.array(*[F.when(~h, F.lit(f)) for f, h in zip(REQUIRED_FIELDS, has)])),
                       "_conf": F.coalesce(F.when(said.isin("true", "false"), bare_boolean_confidence("_t", "_doc"))
                                           .when(said.isin('"Infinity"', '"-Infinity"'), overflowing_confidence(said, "_doc")),
                                           parse_float_text(said))})
    kind, miss, conf, j = F.col("_kind"), F.col("_miss"), F.col("_conf"), F.col("_j")
    t = t.withColumn("_outcome", F.when(kind.isNull(), "invalid_json")
                     .when(kind.isin("array", "string"), "missing_fields")
                     .when(kind != "object", "not_object")
                     .when(F.size(miss) > 0, "missing_fields")
                     .when(conf.isNull(), "bad_confidence")
                     .when(F.isnan(conf), "nan_confidence")
                     .when((conf < 0) | (conf > 1), "clamped")
                     .otherwise("ok"))
    if on_invalid not in ("default", "raw", "drop"):
        raise ValueError(f"on_invalid: {on_invalid}")
    outcome = F.col("_outcome")
    default = outcome.isin("invalid_json", "missing_fields", "not_object", "nan_confidence")
    value = F.when(default, F.lit("0")).otherwise(F.coalesce(j["value"], F.lit("None")))
    if on_invalid == "raw":
        value = F.when(outcome == "invalid_json", F.coalesce(F.col(raw), F.lit(""))).otherwise(value)
    confidence = (F.when(default | (outcome == "bad_confidence"), F.lit(0.0))
                  .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), conf))))
    all_missing = F.array(*[F.lit(f) for f in REQUIRED_FIELDS])
    reasoning = (F.when(outcome == "invalid_json", F.lit(MSG_PARSE))
                 .when(kind.isin("array", "string"), F.concat(F.lit(MSG_MISSING), py_list_text(all_missing)))
                 .when(outcome == "missing_fields", F.concat(F.lit(MSG_MISSING), py_list_text(miss)))
                 .when(outcome.isin("not_object", "nan_confidence"), F.lit(MSG_VALIDATE))
                 .otherwise(F.coalesce(j["reasoning"], F.lit("None"))))
    t = t.withColumns({"ai_code": value, "confidence": confidence, "reasoning": reasoning, "outcome": outcome})
    t = t.withColumn("confidence_level", confidence_level(F.col("confidence")))
    # Answers per outcome as observed metrics of the query (read with pyspark.sql.Observation or a
    # query listener). The metrics node also keeps later filters on ``outcome`` from being pushed
    # into the staged projections, where alias substitution would inline every JSON parse.
    # Pass a ``pyspark.sql.Observation`` to read the counts after the first action.
    t = t.observe(observation or _metrics_name("validation"), F.count(F.lit(1)).alias("answers"),
                  *[F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES])
    if on_invalid == "drop":
        t = t.filter(F.col("outcome") != "invalid_json")
    if keep_clean:
        t = t.withColumnRenamed("_clean", "clean")
    return t.drop(*_TMP)


def validation_report(validated: DataFrame, by: str = "category") -> DataFrame:
    """Answers per category and outcome (the reference only logs these)."""
    return validated.groupBy(by, "outcome").agg(F.count(F.lit(1)).alias("n"))
