"""Schemes as whole documents: ``{"coding_scheme": {"version": ..., "categories": {key: {display_name, simplified_name,
criteria, examples, values, condition}}}}``, JSON, one document per scheme.

A document is read once into a VARIANT; categories come out of it by a generator, in document order, each field with its own
type as it stands.  Every broken structure and every wrong type has a rule of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CONDITION = "struct<type:string,reference:string,range_start:string,range_end:string,value:string>"

#: Structure checks in the order in which they are made, and what is said of each.
STRUCTURE = {
    "invalid_json": "not a JSON document, or an object that repeats a key",
    "root_not_object": "the document must be a dictionary",
    "missing_root": "missing 'coding_scheme' root object",
    "coding_scheme_not_object": "coding_scheme must be a dictionary",
    "missing_version": "coding_scheme must have 'version' field",
    "missing_categories": "coding_scheme must have 'categories' field",
    "categories_not_object": "categories must be a dictionary",
}


class SchemeStructureError(ValueError):
    pass


def kind(v: Column) -> Column:
    """OBJECT, ARRAY, STRING, BIGINT, VOID ... of a VARIANT; NULL where there is none."""
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(scheme_id, document): one row per file; the id is the file's ``scheme_id=`` folder or else its name without ending."""
    files = spark.read.text(path, wholetext=True)
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1)
    own = F.col("scheme_id").cast("string") if "scheme_id" in files.columns else F.lit(None).cast("string")
    return files.select(F.coalesce(own, name).alias("scheme_id"), F.col("value").alias("document"))


def _parsed(docs: DataFrame, document: str) -> DataFrame:
    """``docs`` with the document's parts, and ``problem``: the first structure check that fails (NULL: none)."""
    v = F.try_parse_json(document)
    part = lambda path: F.expr(f"try_variant_get(_doc, '{path}', 'variant')")
    out = docs.withColumn("_doc", v).withColumns({
        "_root": part("$.coding_scheme"), "_version": part("$.coding_scheme.version"), "_categories": part("$.coding_scheme.categories")})
    problem = (F.when(F.col("_doc").isNull(), "invalid_json")
               .when(kind(F.col("_doc")) != "OBJECT", "root_not_object")
               .when(F.col("_root").isNull(), "missing_root")
               .when(kind(F.col("_root")) != "OBJECT", "coding_scheme_not_object")
               .when(F.col("_version").isNull(), "missing_version")
               .when(F.col("_categories").isNull(), "missing_categories")
               .when(kind(F.col("_categories")) != "OBJECT", "categories_not_object"))
    return out.withColumn("problem", problem)


def structure_problems(docs: DataFrame, document: str = "document") -> DataFrame:
    """(scheme_id, problem) of the documents whose structure is broken."""
    return _parsed(docs, document).where(F.col("problem").isNotNull()).select("scheme_id", "problem")


def categories(docs: DataFrame, document: str = "document") -> DataFrame:
    """One row per category of the documents whose structure is sound: scheme_id, version, ordinal (its place in the
    document, from 0), key, the fields as text, and ``problems``: what is missing or of a wrong type.

    Fields that are missing, null or of a wrong type are NULL. An example that is no string counts by its JSON text, as numbers do
    in the reference's lists."""
    sound = _parsed(docs, document).where(F.col("problem").isNull())
    # VARIANT sorts the fields of an object; a map read from the text has them in the order of the document, each with a VARIANT of
    # its own. A category so gets its place from the generator: no list of all keys goes along with it.
    body = F.from_json(document, "struct<coding_scheme:struct<categories:map<string,variant>>>")["coding_scheme"]["categories"]
    rows = sound.select("scheme_id", F.expr("try_variant_get(_version, '$', 'string')").alias("version"),
                        F.posexplode(body).alias("ordinal", "key", "_c"))
    rows = rows.select("scheme_id", "version", F.col("ordinal").cast("bigint").alias("ordinal"), "key", "_c", kind(F.col("_c")).alias("_kind"))
    names = ("display_name", "simplified_name", "criteria", "examples", "values")
    fields = {n: F.expr(f"try_variant_get(_c, '$.{n}', 'variant')") for n in names}
    rows = rows.withColumns({f"_{n}": v for n, v in fields.items()}).withColumns({f"_k_{n}": kind(F.col(f"_{n}")) for n in names})
    is_object = F.col("_kind") == "OBJECT"

    def wrong(n: str, kinds: str, rule: str) -> Column:
        return F.when(is_object & F.col(f"_k_{n}").isNotNull() & (F.col(f"_k_{n}") != kinds), F.lit(rule))

    rules = F.array(
        F.when(~is_object, F.lit("category_not_object")),
        *[F.when(is_object & F.col(f"_k_{n}").isNull(), F.lit(f"missing_{n}")) for n in ("criteria", "examples", "values")],
        wrong("examples", "ARRAY", "examples_not_list"), wrong("values", "STRING", "values_not_string"),
        wrong("criteria", "STRING", "criteria_not_string"), wrong("display_name", "STRING", "display_name_not_string"))

    def text(n: str) -> Column:
        return F.when(F.col(f"_k_{n}") == "STRING", F.expr(f"try_variant_get(_{n}, '$', 'string')"))

    return rows.select(
        "scheme_id", "version", "ordinal", "key", text("display_name").alias("display_name"), text("simplified_name").alias("simplified_name"),
        text("criteria").alias("criteria"),
        F.when(F.col("_k_examples") == "ARRAY", F.expr("try_variant_get(_examples, '$', 'array<string>')")).alias("examples"),
        text("values").alias("values_text"),
        F.expr(f"try_variant_get(_c, '$.condition', '{CONDITION}')").alias("condition"),
        F.filter(rules, lambda r: r.isNotNull()).alias("problems"))


def documents(scheme: DataFrame, version: str) -> DataFrame:
    """(scheme_id, document): every scheme as one document, its categories in the order of ``ordinal``; fields that are NULL are
    left out. A key that a scheme holds twice is an error. One document is one value, so it must fit in memory; the
    flat form of :func:`coderail.operators.scheme.assemble_scheme` has no such limit."""
    fields = F.struct("display_name", "simplified_name", "criteria", "examples", F.col("values_text").alias("values"), "condition")
    one = F.struct("ordinal", "key", fields.alias("category"))
    whole = scheme.groupBy("scheme_id").agg(F.array_sort(F.collect_list(one)).alias("_c"))
    entries = F.transform("_c", lambda c: F.struct(c["key"], c["category"]))
    body = F.struct(F.struct(F.lit(version).alias("version"), F.map_from_entries(entries).alias("categories")).alias("coding_scheme"))
    return whole.select("scheme_id", F.to_json(body).alias("document"))


def write_documents(docs: DataFrame, path: str) -> str:
    """One folder ``scheme_id=`` per scheme, with the document as its one file."""
    (docs.repartition("scheme_id").write.mode("overwrite").option("lineSep", "\n").partitionBy("scheme_id").text(path))
    return path


def load_documents(spark: SparkSession, path: str) -> DataFrame:
    """The categories of all documents below a path. A document of broken structure is refused with the check it fails."""
    docs = read_documents(spark, path)
    broken = structure_problems(docs).limit(5).collect()
    if broken:
        raise SchemeStructureError("; ".join(f"{r['scheme_id']}: {STRUCTURE[r['problem']]}" for r in broken))
    return categories(docs)
