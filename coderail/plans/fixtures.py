"""Test inputs derived from the driver tables (FIXTURES.md).

Every fixture is one SQL text that runs unchanged in Spark SQL and DuckDB over the driver's tables.
The Spark side registers the parquet tables as temp views and runs the text; the oracle side
embeds the same text as a CTE. All fixtures grow with the tables they read.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# The whole first line and a digest of the text: only equal texts share a title, and the ids that are
# meant to (each of 7 course names is used by several different texts).
TITLE = """CASE WHEN doc_id % 60 = 9 THEN concat('Kurs ', CAST(doc_id % 7 AS STRING))
       ELSE concat(split_part(text, chr(10), 1), ' #', substr(md5(text), 1, 12)) END"""

ENTRIES_RAW = f"""
SELECT doc_id AS ordinal,
  CASE WHEN doc_id % 50 = 7 THEN NULL WHEN doc_id % 50 = 8 THEN '   '
       ELSE concat('  ', {TITLE}, ' ') END AS title,
  CASE WHEN doc_id % 40 = 3 THEN NULL ELSE text END AS description, lang, source
FROM documents
"""

CODES_RAW = f"""
SELECT doc_id AS ordinal, concat({TITLE}, '  ') AS title,
  CASE WHEN doc_id % 31 = 0 THEN '2' WHEN doc_id % 37 = 0 THEN NULL
       ELSE CAST(quality AS STRING) END AS human_code_quality,
  CAST(toxic AS STRING) AS human_code_toxic
FROM (SELECT l.doc_id, l.quality, l.toxic, d.text FROM labels l JOIN documents d ON l.doc_id = d.doc_id) x
"""

SELECTED = """
SELECT * FROM (VALUES (1,'quality'),(2,'toxic'),(3,'Laenge'),(4,'quality'),(5,'unknown')) AS t(ordinal, key)
"""

RESPONSES_RAW = """
SELECT doc_id, category, attempt, CASE
  WHEN doc_id % 29 = 11 THEN '<html>503 Service Unavailable</html>'
  WHEN m < 5 THEN concat('{"value": "', v, '", "confidence": 0.', c, ', "reasoning": "r', CAST(doc_id AS STRING), '"}')
  WHEN m = 5 THEN concat('Antwort: ```json', chr(10), '{"value": ', v, ', "confidence": 0.', c, ', "reasoning": "fenced"}', chr(10), '``` Ende')
  WHEN m = 6 THEN concat('```', chr(10), '{"value": "', CASE WHEN v = '1' THEN 'Ja (1)' ELSE 'Nein (0)' END, '", "confidence": "0.', c, '", "reasoning": "plain"}')
  WHEN m = 7 THEN concat('{"value": " JA ", "confidence": ', CASE WHEN v = '1' THEN '1.7' ELSE '-0.2' END, ', "reasoning": ""}')
  WHEN m = 8 THEN concat('{"value": "', v, '", "confidence": 0.', c, '}')
  WHEN m = 9 THEN concat('{"value": "', v, '", "confidence": 0.', c, ', "reasoning": "no comma" "citation": "x"}')
  WHEN m = 10 THEN '{"value": "-99", "confidence": "hoch", "reasoning": null}'
  WHEN m = 11 THEN CASE WHEN v = '1' THEN '<html>502</html>' ELSE '' END
  WHEN m = 12 THEN concat('{"value": "', v, '", "confidence": 0.', c, ', "reasoning": "two"} {"x": 1}')
  WHEN m = 13 THEN concat('{"value": "', v, '", "confidence": Infinity, "reasoning": "bare"}')
  WHEN m = 14 THEN concat('{"value": "', v, '", "confidence": ', CASE WHEN v = '1' THEN 'true' ELSE 'false' END, ', "reasoning": "boolean"}')
  WHEN m = 15 THEN '42'
  WHEN m = 16 THEN concat('["', v, '", 0.', c, ']')
  ELSE concat('{"value": "', v, '", "confidence": NaN, "reasoning": "bare"}') END AS raw
FROM (SELECT d.doc_id, s.category, a.attempt,
        (d.doc_id + s.o * 5 + (a.attempt - 1) * 7) % 18 AS m,
        CASE WHEN (d.doc_id * 3 + s.o) % 5 < 3 THEN '1' ELSE '0' END AS v,
        lpad(CAST((d.doc_id * 37 + s.o * 11) % 100 AS STRING), 2, '0') AS c
      FROM documents d
      CROSS JOIN (SELECT * FROM (VALUES (0,'quality'),(1,'toxic'),(2,'length')) AS t(o, category)) s
      CROSS JOIN (SELECT * FROM (VALUES (1),(2),(3)) AS u(attempt)) a) x
"""

SCHEME_ROWS = """
SELECT concat('p', CAST(p_size AS STRING)) AS scheme_id, p_partkey AS ordinal,
  concat(CAST(p_partkey % 4 AS STRING), '.', CAST(p_partkey % 7 AS STRING),
    CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'a' WHEN 2 THEN concat('.', CAST(p_partkey % 5 AS STRING))
      ELSE concat('.', CAST(p_partkey % 5 AS STRING), '.', CAST(p_partkey % 3 AS STRING)) END, ' ', p_name) AS display_name,
  CASE p_partkey % 11 WHEN 0 THEN 'Ja (1), Nein (0)' WHEN 1 THEN 'JA oder nein' WHEN 2 THEN 'Offen'
    WHEN 3 THEN concat('A', chr(10), ' B ', chr(10), chr(10), 'C')
    WHEN 4 THEN 'Seminar (1);; Event (2);; Event (2); -99'
    WHEN 5 THEN concat('Ja (1) wenn min. eine der Kategorien ', CAST(p_partkey % 4 AS STRING), '.1-', CAST(p_partkey % 4 AS STRING), '.4 = 1', chr(10), 'oder Nein (0)')
    WHEN 6 THEN concat('Wenn ', p_brand, CASE WHEN p_partkey % 2 = 0 THEN ' = 2' ELSE ' = 2 = 3' END, chr(10), ' Offen; -99')
    WHEN 7 THEN 'a, b, a' WHEN 8 THEN 'Ja (1), nur, wenn auch 2.0.4 =1; Nein (0)'
    WHEN 9 THEN 'Ja (1) wenn min. eine der Kategorien 2.0.3.1 & 2.0.3.2 = 1' ELSE '' END AS values_text,
  CASE WHEN p_partkey % 3 = 0 THEN concat('Kriterium:  ', p_type, ' "x"') ELSE '' END AS criteria,
  CASE WHEN p_partkey % 2 = 0 THEN concat('• ', p_name, chr(10), '  ', chr(10), '· "', p_brand, '"') ELSE '' END AS examples
FROM part
"""

LEAF_CODES = """
SELECT d.doc_id, n.number,
  CASE WHEN (d.doc_id * 13 + n.o * 29) % 31 < 4 THEN '1' WHEN (d.doc_id + n.o) % 17 = 0 THEN '-99' ELSE '0' END AS code
FROM documents d CROSS JOIN (SELECT * FROM (VALUES
  (1,'2.1.1'),(2,'2.1.2'),(3,'2.1.3'),(4,'2.1.4'),(5,'2.2.1'),(6,'2.2.2'),(7,'2.2.3'),
  (8,'2.3.1'),(9,'2.3.2'),(10,'2.3.3'),(11,'2.3.4'),(12,'2.4.1'),(13,'2.4.2'),(14,'2.4.3'),
  (15,'2.5.1'),(16,'2.5.2'),(17,'2.5.3'),(18,'2.6.1'),(19,'2.6.2'),(20,'2.6.3'),(21,'2.6.4'),(22,'2.6.5'),
  (23,'3.1'),(24,'3.2'),(25,'3.3'),(26,'3.4'),(27,'3.5')) AS t(o, number)) n
"""

DERIVED_RULES = """
SELECT * FROM (VALUES (1,'2.1','2.1.1','2.1.4','1'),(1,'2.2','2.2.1','2.2.3','1'),(1,'2.3','2.3.1','2.3.4','1'),
  (1,'2.4','2.4.1','2.4.3','1'),(1,'2.5','2.5.1','2.5.3','1'),(1,'2.6','2.6.1','2.6.5','1'),
  (1,'3','3.1','3.5','1'),(2,'2.0.4','2.1','2.6','1')) AS t(level, number, range_start, range_end, code)
"""

PROVIDER_CODES = """
SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '2' WHEN doc_id % 11 = 5 THEN '7' ELSE '1' END AS provider,
  concat('name ', CAST(doc_id % 13 AS STRING)) AS open_text
FROM documents
"""

RUNS = """
SELECT concat('20250519_1', lpad(CAST(event_id % 97 AS STRING), 5, '0')) AS run_id, event_id, event_type AS category, value
FROM events
"""

# The three categories that texts are coded against in the pipeline fixtures. The criteria of
# "quality" contains a placeholder on purpose: replacement is sequential, so it is expanded.
TASK_SCHEME = """
SELECT * FROM (VALUES
  (1, 'quality', '1.1 Textqualitaet', 'Textqualitaet', 'Der Text ist zusammenhaengend; erlaubt sind [values].',
      'klarer Absatz' || chr(10) || 'keine Fragmente', 'Ja (1), Nein (0)'),
  (2, 'toxic', '1.2 Beleidigung', 'Beleidigung', 'Der Text enthaelt abwertende Sprache.', '', 'Ja (1), Nein (0)'),
  (3, 'length', '1.3 Laenge', 'Laenge', 'Der Text ist laenger als zweitausend Zeichen.', 'ein langer Bericht',
      'Ja (1), Nein (0)')
) AS t(ordinal, key, display_name, simplified_name, criteria, examples_text, values_text)
"""

# Spark formulations of the two fixtures whose portable SQL fans rows out with CROSS JOIN over a
# VALUES list: the same rows come from a generator (LATERAL VIEW inline / explode), so the Spark
# plan has no join at all. The portable text stays the oracle's; the values are shared below.
_RESPONSE_CATEGORIES = [(0, "quality"), (1, "toxic"), (2, "length")]
_LEAF_NUMBERS = ["2.1.1", "2.1.2", "2.1.3", "2.1.4", "2.2.1", "2.2.2", "2.2.3", "2.3.1", "2.3.2", "2.3.3", "2.3.4",
                 "2.4.1", "2.4.2", "2.4.3", "2.5.1", "2.5.2", "2.5.3", "2.6.1", "2.6.2", "2.6.3", "2.6.4", "2.6.5",
                 "3.1", "3.2", "3.3", "3.4", "3.5"]


def _inline(pairs, names) -> str:
    items = ", ".join("named_struct(" + ", ".join(f"'{n}', {v!r}" if isinstance(v, str) else f"'{n}', {v}"
                                                   for n, v in zip(names, p)) + ")" for p in pairs)
    return f"inline(array({items}))"


RESPONSES_RAW_SPARK = RESPONSES_RAW.replace("""      FROM documents d
      CROSS JOIN (SELECT * FROM (VALUES (0,'quality'),(1,'toxic'),(2,'length')) AS t(o, category)) s
      CROSS JOIN (SELECT * FROM (VALUES (1),(2),(3)) AS u(attempt)) a) x""", f"""      FROM documents d
      LATERAL VIEW {_inline(_RESPONSE_CATEGORIES, ("o", "category"))} s AS o, category
      LATERAL VIEW explode(array(1, 2, 3)) a AS attempt) x""")

LEAF_CODES_SPARK = f"""
SELECT d.doc_id, n.number,
  CASE WHEN (d.doc_id * 13 + n.o * 29) % 31 < 4 THEN '1' WHEN (d.doc_id + n.o) % 17 = 0 THEN '-99' ELSE '0' END AS code
FROM documents d LATERAL VIEW {_inline(list(enumerate(_LEAF_NUMBERS, 1)), ("o", "number"))} n AS o, number
"""

SPARK_VARIANTS = {"responses_raw": RESPONSES_RAW_SPARK, "leaf_codes": LEAF_CODES_SPARK}
assert RESPONSES_RAW_SPARK != RESPONSES_RAW

FIXTURES: dict[str, str] = {
    "entries_raw": ENTRIES_RAW,
    "codes_raw": CODES_RAW,
    "selected": SELECTED,
    "responses_raw": RESPONSES_RAW,
    "scheme_rows": SCHEME_ROWS,
    "leaf_codes": LEAF_CODES,
    "derived_rules": DERIVED_RULES,
    "provider_codes": PROVIDER_CODES,
    "runs": RUNS,
    "task_scheme": TASK_SCHEME,
}


_REGISTERED: dict[tuple[int, str], str] = {}


def register_tables(spark: SparkSession, sf_dir: str, names=BASE_TABLES) -> None:
    """Expose the driver tables as temp views (lazy parquet scans). Registration lists files and
    reads footers, so a view already bound to the same folder in this session is not re-registered."""
    sf = sf_dir.rstrip("/")
    for n in names:
        k = (id(spark), n)
        if _REGISTERED.get(k) == sf and spark.catalog.tableExists(n):
            continue
        spark.read.parquet(f"{sf}/{n}.parquet").createOrReplaceTempView(n)
        _REGISTERED[k] = sf


def _tables_in(sql: str) -> list[str]:
    words = set(re.findall(r"[a-z_]+", sql))
    return [t for t in BASE_TABLES if t in words]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as a DataFrame."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One fixture as a DataFrame. The plan is bound at analysis time, so later view swaps do not leak in."""
    sql = SPARK_VARIANTS.get(name, FIXTURES[name])
    register_tables(spark, sf_dir, _tables_in(sql))
    return spark.sql(sql)
