"""Scheme tables: ``scheme_rows(scheme_id, ordinal, display_name, values_text, criteria, examples)`` of
any number of schemes, normalised into ``scheme(scheme_id, ordinal, key, display_name, simplified_name,
criteria, examples, values_text, condition)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scheme as S
from ..functions.text import py_strip
from ..session import scratch_path
from ..sources.scheme_documents import SchemeStructureError, documents, load_documents, write_documents

SCHEME_VERSION = "1.0"


def unique_keys(df: DataFrame, group: str = "scheme_id", key: str = "key", order: str = "ordinal") -> DataFrame:
    """A repeated key gets ``_1``, ``_2``... in row order, counting on past names that are taken; the
    first stays bare. Rows whose key is empty are dropped (the importer skips them).

    Positions come from the skew-safe :func:`coderail.operators.ranking.rank_within`. A numbered name
    can only meet another key of its family (the same key without trailing numbers), so only families
    with a repeated key next to a different one are settled row by row, from (order, key) alone. Rows of equal
    order stay rows of their own (in any order among them); NULL groups are one group.

    Only (group, key, order) and a row number are ranked and settled; every other column meets the result once, by row number.
    """
    from .ranking import rank_within
    whole = _numbered(df.filter(F.col(key) != ""))
    d = rank_within(whole.select("_uid", group, key, order), [group, key], order, out="_rn")
    d = d.withColumn("_root", F.regexp_replace(key, "(_[0-9]+)+$", ""))
    mixed = (d.groupBy(group, "_root").agg(F.min(key).alias("_lo"), F.max(key).alias("_hi"), F.max("_rn").alias("_most"))
             .filter((F.col("_lo") != F.col("_hi")) & (F.col("_most") > 0))
             .select(F.col(group).alias("_g"), F.col("_root").alias("_r")))

    def settle(pdf):
        used, counters, names = set(), {}, []
        pdf = pdf.sort_values([order, "_uid"], kind="stable")
        for k in pdf[key]:
            name = k
            if k in used:
                n = counters.get(k, 1)
                while f"{k}_{n}" in used:
                    n += 1
                counters[k], name = n + 1, f"{k}_{n}"
            used.add(name)
            names.append(name)
        return pdf[["_uid"]].assign(_name=names)

    family = F.col(group).eqNullSafe(F.col("_g")) & (F.col("_root") == F.col("_r"))
    settled = (d.join(mixed, family, "left_semi").select("_uid", group, "_root", order, key)
               .groupBy(group, "_root").applyInPandas(settle, "_uid long, _name string"))
    rn = F.col("_rn")
    counted = F.when(rn == 0, F.col(key)).otherwise(F.concat(F.col(key), F.lit("_"), rn.cast("string")))
    names = d.select("_uid", counted.alias("_counted")).join(settled, "_uid", "left").select("_uid", F.coalesce("_name", "_counted").alias("_name"))
    return whole.join(names, "_uid").withColumn(key, F.col("_name")).select(*df.columns)


def _numbered(df: DataFrame) -> DataFrame:
    """``df`` with a number per row, written once: a recomputation could number rows differently."""
    out = df.withColumn("_uid", F.monotonically_increasing_id())
    path = scratch_path(df.sparkSession, "numbered")
    out.write.parquet(path)
    return df.sparkSession.read.schema(out.schema).parquet(path)


def normalise_scheme(rows: DataFrame, group: str = "scheme_id", order: str = "ordinal") -> DataFrame:
    """Importer: skip empty rows -> key -> condition -> ``_DERIVED_`` prefix -> examples/criteria ->
    unique keys -> standardised values. ``display_name`` is carried through unchanged.

    Everything but the unique-key step is a projection; that step writes the rows once, ranks (scheme, key, ordinal) by a range
    shuffle with a checkpoint, and joins the names back by row number.
    """
    dn, vals = py_strip(F.col("display_name")), py_strip(F.col("values_text"))
    crit, exs = py_strip(F.col("criteria")), py_strip(F.col("examples"))
    base = rows.select(group, order, dn.alias("display_name"), vals.alias("_values"), crit.alias("_criteria"),
                       exs.alias("_examples"))
    base = base.filter(~((F.col("display_name") == "") & (F.col("_values") == "") & (F.col("_criteria") == "")
                         & (F.col("_examples") == "")))
    base = base.withColumn("_key", S.generate_key(F.col("display_name"))).filter(F.col("_key") != "")
    cond = S.parse_condition(F.col("_values"))
    key = F.col("_key")
    out = base.select(
        group, order, "display_name",
        F.when(cond.isNotNull(), F.concat(F.lit(S.DERIVED_PREFIX), key)).otherwise(key).alias("key"),
        S.import_criteria(F.col("_criteria")).alias("criteria"),
        S.example_lines(F.col("_examples")).alias("examples"),
        S.standardise_values(S.values_prestep(F.col("_values"))).alias("values_text"),
        cond.alias("condition"),
        S.condition_problem(F.col("_values")).alias("condition_problem"))
    return unique_keys(out, group, "key", order).withColumn("simplified_name", S.clean_name(F.col("display_name")))


def filter_categories(scheme: DataFrame, include_derived: bool = True, name: str = "display_name",
                      position: str | None = None) -> DataFrame:
    """Categories offered for selection: first token of the display name (key as fallback) has a
    digit; with the sort key columns n1, n2, n3, suffix. Order = (sort key, ordinal), a stable sort:
    four-level numbers tie with their three-level parent and keep input order.

    The order is returned as a global ``orderBy`` (range-partitioned, so a large scheme is spread
    over many tasks). ``position`` names an optional 0-based column with the place of the category
    in its scheme's menu, computed by the skew-safe :func:`coderail.operators.ranking.rank_within`.
    """
    label = F.coalesce(F.col(name), F.col("key")) if "key" in scheme.columns else F.col(name)
    out = scheme.filter(S.has_number(label))
    if not include_derived and "key" in scheme.columns:
        out = out.filter(~F.col("key").startswith(S.DERIVED_PREFIX))
    k = S.category_sort_key(label)
    out = out.withColumns({"n1": k["n1"], "n2": k["n2"], "n3": k["n3"], "suffix": k["suffix"]})
    if position:
        from .ranking import rank_within
        out = out.withColumn("_menu", F.struct("n1", "n2", "n3", "suffix", "ordinal"))
        out = rank_within(out, ["scheme_id"], "_menu", out=position).drop("_menu")
    return out.orderBy("scheme_id", "n1", "n2", "n3", "suffix", "ordinal")


def drop_derived(scheme: DataFrame) -> DataFrame:
    """Update path of the current pipeline: derived categories are removed."""
    return scheme.filter(~F.col("key").startswith(S.DERIVED_PREFIX))


def fix_scheme(scheme: DataFrame) -> DataFrame:
    """The fix step between import and validation: the key becomes the display name, its number is cut
    for ``simplified_name``, criteria, examples (texts or key/value maps) and values are cleaned; conditions stay."""
    if scheme.schema["examples"].dataType.simpleString().startswith("array<map"):
        scheme = scheme.withColumn("examples", S.dict_examples(F.col("examples")))
    return scheme.withColumns({
        "display_name": F.col("key"), "simplified_name": S.simplify_name(F.col("key")),
        "criteria": S.clean_criteria(F.coalesce("criteria", F.lit(""))),
        "examples": S.clean_examples(F.coalesce("examples", F.array().cast("array<string>"))),
        "values_text": S.clean_values(F.col("values_text"))})


def build_scheme(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Import -> fix -> validate: the fixed scheme and its violations (an empty table: valid)."""
    fixed = fix_scheme(normalise_scheme(rows))
    return fixed, scheme_violations(fixed)


def scheme_violations(scheme: DataFrame, group: str = "scheme_id", order: str = "ordinal") -> DataFrame:
    """Every violated rule per category (the validator stops at the first):
    duplicate_name (a later category with the same bare name), key_collision (a later category with the
    same key), missing_criteria, missing_examples, missing_values, condition_unpacking; for categories of whole documents also
    category_not_object (that rule alone), examples_not_list, values_not_string, criteria_not_string, display_name_not_string.

    A category without a display name goes by its key, as in the validator; one without either still
    gets its other rules. Both tests are aggregates (first ordinal per name, per key) joined back, not
    windows, so a name shared by many rows is combined map-side and the joins can be split by AQE.
    """
    key = F.coalesce("key", F.lit(""))
    typed = "problems" in scheme.columns  # categories of whole documents: what is missing or wrong was seen in the document
    other = F.array_contains("problems", "category_not_object") if typed else F.lit(False)
    named = scheme.withColumns({"_bare": F.when(other, "").otherwise(S.bare_name(F.coalesce("display_name", key))), "_key": key})
    first = named.groupBy(F.col(group).alias("_g1"), F.col("_bare").alias("_b1")).agg(F.min(order).alias("_first"))
    first_key = named.groupBy(F.col(group).alias("_g2"), F.col("_key").alias("_k2")).agg(F.min(order).alias("_first_key"))
    j = (named.join(first, F.col(group).eqNullSafe(F.col("_g1")) & (F.col("_bare") == F.col("_b1")))
         .join(first_key, F.col(group).eqNullSafe(F.col("_g2")) & (F.col("_key") == F.col("_k2"))))
    rules = F.array(
        F.when((F.col(order) > F.col("_first")) & (F.col("_bare") != ""), F.lit("duplicate_name")),
        F.when((F.col(order) > F.col("_first_key")) & (F.col("_key") != ""), F.lit("key_collision")),
        *([] if typed else [F.when(F.col(c).isNull(), F.lit(r)) for c, r in (
            ("criteria", "missing_criteria"), ("examples", "missing_examples"), ("values_text", "missing_values"))]),
        F.col("condition_problem") if "condition_problem" in scheme.columns else F.lit(None).cast("string"))
    return j.select(group, order, F.explode(F.filter(F.concat(rules, "problems") if typed else rules, lambda r: r.isNotNull())).alias("rule"))


def assemble_documents(scheme: DataFrame, path: str, version: str = SCHEME_VERSION) -> str:
    """Writes every scheme as one nested document (version, categories in scheme order), as the generator does."""
    return write_documents(documents(scheme, version), path)


CATEGORY_JSON_SCHEMA = (
    "scheme_id string, version string, ordinal bigint, key string, display_name string, simplified_name string, "
    "criteria string, examples array<string>, values_text string, "
    "condition struct<type:string, reference:string, range_start:string, range_end:string, value:string>")


def assemble_scheme(scheme: DataFrame, path: str, version: str = SCHEME_VERSION) -> str:
    """Writes every scheme as one JSON-lines document (a folder per scheme, one line per category in
    scheme order). Distributed write: no scheme is gathered into one row, one task or the driver.

    Range partitioning on (scheme, ordinal) spreads a large scheme over several tasks; each task
    writes an ordered slice, and the part-file numbers follow the ranges, so file name + line
    order is scheme order."""
    cols = [c.split(" ")[0] for c in CATEGORY_JSON_SCHEMA.split(", ") if not c.startswith("condition")]
    out = scheme.withColumn("version", F.lit(version))
    out = out.select(*[c for c in cols if c in out.columns], "condition")
    (out.repartitionByRange("scheme_id", "ordinal").sortWithinPartitions("scheme_id", "ordinal")
     .write.mode("overwrite").partitionBy("scheme_id").json(path))
    return path


def load_scheme(spark, path: str) -> DataFrame:
    """Reads schemes: whole documents (version and a map of categories, see :mod:`coderail.sources.scheme_documents`), or the flat
    lines of :func:`assemble_scheme` (or any JSON lines of that shape) with an explicit schema. A structure that misses a field everywhere
    is refused; otherwise a ``problem`` column per category (missing version / key / values)."""
    first = spark.read.text(path).where(F.length(py_strip(F.col("value"))) > 0).select(
        F.json_object_keys("value").alias("keys")).first()
    if first is not None and (first["keys"] is None or "key" not in first["keys"]):  # no line of a category
        whole = load_documents(spark, path)
        return whole.withColumn("problem", F.array_join("problems", ", ")).withColumn("problem", F.nullif("problem", F.lit("")))
    found = spark.read.json(path).columns  # what the documents really hold, before the schema fills it up
    missing = [c for c in ("version", "key", "criteria", "examples", "values_text") if c not in found]
    if missing:
        raise SchemeStructureError(f"coding_scheme must have {missing}")
    df = spark.read.schema(CATEGORY_JSON_SCHEMA).json(path)
    problem = (F.when(F.col("version").isNull(), F.lit("missing_version"))
               .when(F.col("key").isNull(), F.lit("missing_key"))
               .when(F.col("values_text").isNull(), F.lit("missing_values")))
    return df.withColumn("problem", problem)
