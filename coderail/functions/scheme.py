"""Scheme-table text rules as Column expressions (names, keys, conditions, allowed values).

Regexes follow Python ``re`` semantics for the inputs that occur (ASCII digits in numbers); ``\\s`` is
widened to Python's whitespace set with ``(?U)`` plus U+001C..U+001F.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WS, collapse_whitespace, first_token, py_strip

DERIVED_PREFIX = "_DERIVED_"


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def _strip_chars(c: Column, chars: str) -> Column:
    """Python ``s.strip(chars)`` for a small set of literal characters."""
    cls = "".join("\\" + ch if ch in "\\]^-[" else ch for ch in chars)
    return F.regexp_replace(c, f"^[{cls}]+|[{cls}]+$", "")


# ------------------------------------------------------------------ S1 sort key
def category_sort_key(display_name) -> Column:
    """(n1, n2, n3, suffix) of the first token: numbers of its dot sections (padded/cut to three),
    letters of the last section that has any; no token -> (999, 999, 999, '')."""
    tok = first_token(_c(display_name))
    secs = F.split(tok, r"\.", -1)
    nums = F.filter(F.transform(secs, lambda s: F.regexp_replace(s, "[^0-9]", "")), lambda d: d != "")
    letters = F.filter(F.transform(secs, lambda s: F.regexp_replace(s, r"[^\p{L}]", "")), lambda x: x != "")
    def n(i):
        return F.when(tok.isNull(), F.lit(999)).otherwise(
            F.coalesce(F.try_element_at(nums, F.lit(i)).try_cast("bigint"), F.lit(0))).cast("bigint")
    suffix = F.when(tok.isNull(), F.lit("")).otherwise(F.coalesce(F.try_element_at(letters, F.lit(-1)), F.lit("")))
    return F.struct(n(1).alias("n1"), n(2).alias("n2"), n(3).alias("n3"), suffix.alias("suffix"))


def has_number(display_name) -> Column:
    """The first token contains a digit (categories without one are not offered)."""
    return F.coalesce(first_token(_c(display_name)).rlike("[0-9]"), F.lit(False))


# ------------------------------------------------------------------ S3 key, S8/S9 names
def generate_key(display_name) -> Column:
    """Drop a leading number like ``2.0a `` then map runs of non-alphanumerics to ``_``, strip ``_``."""
    name = F.regexp_replace(_c(display_name), rf"(?U)^\d+(\.\d+)*[a-z]?{WS}+", "")
    key = F.regexp_replace(name, "[^a-zA-Z0-9]+", "_")
    return _strip_chars(key, "_")


# Numbering patterns removed in sequence from a category name.
SIMPLIFY_PATTERNS = [r"^\d+\.\d+\.?\d*\s*[a-z]?\s*", r"^\.\d+\s*", r"^\d+\s+"]


def simplify_name(name, protect_derived: bool = False) -> Column:
    """Three anchored removals in sequence, then strip. The first pattern can eat a leading
    lower-case letter of the name. ``protect_derived`` keeps a ``_DERIVED_`` prefix (current pipeline)."""
    src = _c(name)
    is_derived = src.startswith(DERIVED_PREFIX)
    base = F.when(is_derived, F.substr(src, F.lit(len(DERIVED_PREFIX) + 1))).otherwise(src) \
        if protect_derived else src
    out = base
    for p in SIMPLIFY_PATTERNS:
        out = F.regexp_replace(out, "(?U)" + p.replace(r"\s", WS), "")
    if protect_derived:
        out = F.when(is_derived, F.concat(F.lit(DERIVED_PREFIX), out)).otherwise(out)
    return py_strip(out)


def clean_name(name) -> Column:
    """Drop ``2.0.3a `` style numbers (two or three parts), keep only letters (incl. umlauts, ß)
    and whitespace, collapse whitespace."""
    out = F.regexp_replace(_c(name), rf"(?U)^\d+\.\d+(\.\d+)?[a-z]?{WS}*", "")
    out = F.regexp_replace(out, r"(?U)[^a-zA-ZäöüÄÖÜß\s\x1c-\x1f]", "")
    return collapse_whitespace(out)


# ------------------------------------------------------------------ S10 criteria, S11 examples
def clean_criteria(criteria) -> Column:
    """Fixer: drop a leading ``Kriterium:``, double -> single quotes, strip."""
    out = F.regexp_replace(_c(criteria), rf"(?U)^Kriterium:{WS}*", "")
    return py_strip(F.replace(out, F.lit('"'), F.lit("'")))


def import_criteria(criteria) -> Column:
    """Importer: collapse whitespace; an empty cell becomes the two-character text ``""``."""
    c = py_strip(_c(criteria))
    return F.when(c == "", F.lit('""')).otherwise(collapse_whitespace(c))


def example_lines(examples) -> Column:
    """Importer: one example per non-blank line, stripped."""
    lines = F.transform(F.split(py_strip(_c(examples)), "\n", -1), lambda l: py_strip(l))
    return F.filter(lines, lambda l: l != "")


def dict_examples(examples_arr: Column) -> Column:
    """Examples given as key/value pairs become texts: ``{"Begriffe": "a", "Form": "b"}`` -> ``Begriffe: a; Form: b``."""
    return F.transform(examples_arr, lambda m: F.array_join(
        F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit(": "), F.coalesce(e["value"], F.lit("None")))), "; "))


def clean_examples(examples_arr: Column, quote: bool = False) -> Column:
    """Fixer per example: drop one leading bullet (``·`` or ``•``) and the blanks after it, strip,
    double -> single quotes; ``quote`` wraps each in double quotes (a file-format artefact)."""
    def one(x):
        e = py_strip(F.replace(py_strip(F.regexp_replace(x, rf"(?U)^[·•]{WS}*", "")), F.lit('"'), F.lit("'")))
        return F.concat(F.lit('"'), e, F.lit('"')) if quote else e
    return F.transform(examples_arr, one)


# ------------------------------------------------------------------ S5 conditions
def parse_condition(values) -> Column:
    """Derived-category condition from a values text (importer rules), or NULL.

    Text after the first ``wenn`` up to the next, lower-cased and stripped.
    ``min. eine der kategorien A-B = v`` -> any_in_range(A, B, v); otherwise ``ref = v`` -> equals.
    No ``=``, a bad range, or texts with ``nur, wenn auch`` + ``2.0.4`` -> NULL. An equality with more
    than one ``=`` (the importer's unpacking fails) -> NULL; :func:`condition_problem` reports it.
    """
    v = F.lower(_c(values))
    cond = py_strip(F.split_part(v, F.lit("wenn"), F.lit(2)))
    excluded = v.contains("nur, wenn auch 2.0.4 =1") | (v.contains("nur, wenn auch") & v.contains("2.0.4"))
    is_range = cond.contains("min. eine der kategorien")
    range_part = py_strip(F.split_part(F.split_part(cond, F.lit("kategorien"), F.lit(2)), F.lit("="), F.lit(1)))
    ends = F.split(range_part, "-", -1)
    n_eq = F.size(F.split(cond, "=", -1)) - 1
    range_ok = (F.size(ends) == 2) & (n_eq >= 1)
    eq_ok = n_eq == 1
    null = F.lit(None).cast("string")
    ctype = (F.when(excluded | ~v.contains("wenn"), null)
             .when(is_range, F.when(range_ok, F.lit("any_in_range")))
             .when(eq_ok, F.lit("equals")))
    return F.when(ctype.isNotNull(), F.struct(
        ctype.alias("type"),
        F.when(ctype == "equals", py_strip(F.split_part(cond, F.lit("="), F.lit(1)))).alias("reference"),
        F.when(ctype == "any_in_range", py_strip(F.get(ends, 0))).alias("range_start"),
        F.when(ctype == "any_in_range", py_strip(F.get(ends, 1))).alias("range_end"),
        py_strip(F.split_part(cond, F.lit("="), F.lit(2))).alias("value")))


def condition_problem(values) -> Column:
    """'condition_unpacking' when an equality condition has more than one ``=``, else NULL."""
    v = F.lower(_c(values))
    cond = py_strip(F.split_part(v, F.lit("wenn"), F.lit(2)))
    excluded = v.contains("nur, wenn auch 2.0.4 =1") | (v.contains("nur, wenn auch") & v.contains("2.0.4"))
    n_eq = F.size(F.split(cond, "=", -1)) - 1
    bad = v.contains("wenn") & ~excluded & ~cond.contains("min. eine der kategorien") & (n_eq > 1)
    return F.when(bad, F.lit("condition_unpacking"))


# ------------------------------------------------------------------ S7 / S12 values
def _parts(s: Column, sep: str, distinct: bool) -> Column:
    arr = F.filter(F.transform(F.split(s, sep, -1), lambda p: py_strip(p)), lambda p: p != "")
    return F.array_distinct(arr) if distinct else arr


def values_prestep(values) -> Column:
    """Importer clean-up before standardising: ``;;`` -> ``;``, ``; ;`` -> ``;``, strip ``;``."""
    s = F.replace(F.replace(_c(values), F.lit(";;"), F.lit(";")), F.lit("; ;"), F.lit(";"))
    return _strip_chars(s, ";")


def standardise_values(values) -> Column:
    """Importer rules, first match wins: conditional text unchanged; ja+nein -> binary; offen;
    line list -> '; '; ';' list -> distinct '; '; ',' list -> distinct ', '; else stripped."""
    s = py_strip(_c(values))
    lo = F.lower(s)
    return (F.when(lo.contains("wenn"), s)
            .when(lo.contains("ja") & lo.contains("nein"), F.lit("Ja (1), Nein (0)"))
            .when(lo.contains("offen"), F.lit("offen"))
            .when(s.contains("\n"), F.array_join(_parts(s, "\n", False), "; "))
            .when(s.contains(";"), F.array_join(_parts(s, ";", True), "; "))
            .when(s.contains(","), F.array_join(_parts(s, ",", True), ", "))
            .otherwise(s))


def clean_values(values, variant: str = "fix") -> Column:
    """Fixer rules (``variant='fix'``) or the current pipeline's (``'current'``): strip blanks and
    outer quotes; conditional text kept; ``offen``; ``;``/``,`` lists -> non-empty parts joined by
    ', ' (duplicates kept). 'current' also trims trailing ``,;``, keeps ``Ja (1)`` and maps ja+nein
    to the binary form. The result is returned without the surrounding quotes the YAML writer adds."""
    s = _strip_chars(py_strip(F.coalesce(_c(values), F.lit(""))), "\"'")
    lo = F.lower(s)
    if variant == "current":
        s = F.regexp_replace(s, "[,;]+$", "")
        lo = F.lower(s)
        joined = F.array_join(_parts(F.replace(s, F.lit(";"), F.lit(",")), ",", False), ", ")
        return (F.when(lo == "offen", F.lit("offen")).when(lo == "ja (1)", F.lit("Ja (1)"))
                .when(lo.contains("wenn"), s)
                .when(lo.contains("ja") & lo.contains("nein"), F.lit("Ja (1), Nein (0)"))
                .when(s.contains(";") | s.contains(","), joined).otherwise(s))
    t = F.replace(F.replace(s, F.lit(";;"), F.lit(";")), F.lit("; ;"), F.lit(";"))
    joined = F.array_join(_parts(F.replace(t, F.lit(";"), F.lit(",")), ",", False), ", ")
    return (F.when(lo.contains("wenn"), s).when(lo == "offen", F.lit("offen"))
            .when(t.contains(";") | t.contains(","), joined).otherwise(t))


# ------------------------------------------------------------------ S15 bare names, S16 value formats
# Fixed value: numbering prefix of a display name.
BARE_NAME = r"(?i)^\d+(?:\.\d+)*(?:\s*[a-z])?\s+(.+)$"


def bare_name(display_name) -> Column:
    """Name without its number prefix (validator rule); the whole name when there is no prefix."""
    d = _c(display_name)
    pat = BARE_NAME.replace(r"\s", WS).replace("(?i)", "(?iU)")
    return F.when(d.rlike(pat), F.regexp_extract(d, pat, 1)).otherwise(d)


# Allowed-values formats of the validator, tried in this order.
VALUE_FORMATS = [
    ("binary", r"^Ja \(1\), Nein \(0\)$"),
    ("open", r"^offen$"),
    ("numbered_choice", r"^[^,]+ \(\d+\), [^,]+ \(\d+\)(?:, [^,]+ \(\d+\))*$"),
    ("numbered_choice_missing", r"^[^,]+ \(\d+\), [^,]+ \(\d+\), -99$"),
    ("semester", r"^SoSe\d{2}; WiSe\d{2}/\d{2}; -99$"),
    ("letter_list", r"^[A-Z]; [A-Z](?:; [A-Z])*; -99$"),
    ("text_list", r"^[^,]+; [^,]+(?:; [^,]+)*; -99$"),
    ("comma_list", r"^[^,]+(?:, [^,]+)*$"),
    ("missing_only", r"^-99$"),
]


def values_format(values) -> Column:
    """First matching allowed-values format; texts starting with lower-case ``wenn`` are exempt
    ('conditional'); none -> 'invalid'."""
    v = _strip_chars(_c(values), "\"'")
    out = F.when(v.startswith("wenn"), F.lit("conditional"))
    for name, pat in VALUE_FORMATS:
        out = out.when(v.rlike(pat), F.lit(name))
    return out.otherwise(F.lit("invalid"))


def allowed_codes(values) -> Column:
    """Codes named in a values text: every ``(n)`` mark plus ``-99`` when it occurs."""
    v = F.coalesce(_c(values), F.lit(""))
    marks = F.regexp_extract_all(v, F.lit(r"\((-?\d+)\)"), 1)
    return F.array_distinct(F.when(v.contains("-99"), F.array_union(marks, F.array(F.lit("-99")))).otherwise(marks))


def is_open_values(values) -> Column:
    return F.lower(_c(values)).contains("offen")
