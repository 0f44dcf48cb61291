"""Model answers as Column expressions: fence removal, JSON checks, field access, confidence coercion.

Mirrors Python's ``json.loads`` + ``float()`` semantics as closely as built-in expressions allow;
the known gap (non-string values rendered as JSON instead of Python repr) is listed in the README.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import py_strip

FENCE_JSON = "```json"
FENCE = "```"
# JSON insignificant whitespace (what json.loads skips around a document).
_JSON_WS_STRIP = r"^[ \t\n\r]+|[ \t\n\r]+$"
# Text that Python's float() accepts (after strip): decimal with optional underscores between
# digits, exponent, or inf/infinity/nan in any case.
FLOAT_TEXT = (r"^[+-]?(((\d+(_\d+)*)(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?"
              r"|(?i:inf|infinity|nan))$")
# Required answer fields in the order the error message lists them.
REQUIRED_FIELDS = ["value", "confidence", "reasoning"]
ANSWER_SCHEMA = "value string, confidence string, reasoning string"


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def strip_fence(raw) -> Column:
    """```json fence -> part after the first marker up to the next fence, stripped; otherwise a
    plain fence -> part after it up to the next one, stripped; otherwise unchanged. An unclosed
    fence keeps everything after the marker."""
    r = _c(raw)
    in_json = F.split_part(F.split_part(r, F.lit(FENCE_JSON), F.lit(2)), F.lit(FENCE), F.lit(1))
    in_plain = F.split_part(F.split_part(r, F.lit(FENCE), F.lit(2)), F.lit(FENCE), F.lit(1))
    return (F.when(r.contains(FENCE_JSON), py_strip(in_json))
            .when(r.contains(FENCE), py_strip(in_plain))
            .otherwise(r))


def json_trimmed(s) -> Column:
    return F.regexp_replace(_c(s), _JSON_WS_STRIP, "")


def bare_literals_quoted(t) -> Column:
    """``json.loads`` reads NaN, Infinity and -Infinity as numbers; the parsers here reject them. In text
    that does not parse as it is, such a literal in value position becomes a string (``float()`` reads both alike).

    Strings are stepped over: with escaped backslashes and quotes put aside (as control characters, which no JSON
    string holds as they are), every second piece between quotes is outside of strings."""
    c = _c(t)
    aside = F.replace(F.replace(c, F.lit("\\\\"), F.lit("\x01")), F.lit('\\"'), F.lit("\x02"))

    def outside(piece: Column, i: Column) -> Column:
        literal = F.regexp_replace(piece, r'([:\[,][ \t\n\r]*)(-?Infinity|NaN)(?=[ \t\n\r]*[,}\]])', '$1"$2"')
        return F.when(i % 2 == 0, literal).otherwise(piece)

    quoted = F.array_join(F.transform(F.split(aside, '"', -1), outside), '"')
    back = F.replace(F.replace(quoted, F.lit("\x02"), F.lit('\\"')), F.lit("\x01"), F.lit("\\\\"))
    clean = ~c.contains("\x01") & ~c.contains("\x02")
    return F.when((c.contains("Infinity") | c.contains("NaN")) & clean & F.try_parse_json(c).isNull(), back).otherwise(c)


def document(t) -> Column:
    """A VARIANT that holds the text's one document as ``$[0]``, or NULL where the text is none.

    The parsers stop after a complete document, whatever follows. In front of one more element of an array, which
    is a digest of the text and so not in it, it can be neither followed by anything nor close the array early."""
    c = _c(t)
    v = F.try_parse_json(F.concat(F.lit("["), c, F.lit(',"'), F.md5(c), F.lit('"]')))
    whole = (F.try_variant_get(v, "$[1]", "string") == F.md5(c)) & F.try_variant_get(v, "$[2]", "variant").isNull()
    return F.when(whole, v)


def one_document(t) -> Column:
    """Nothing follows the first complete document, for text that :func:`document` rejects for its repeated keys: inside
    an array, and inside an object, every rest breaks the syntax of at least one of the two or adds an element."""
    c = _c(t)
    return ((F.json_array_length(F.concat(F.lit("["), c, F.lit("]"))) == 1)
            & F.json_object_keys(F.concat(F.lit('{"k":'), c, F.lit("}"))).isNotNull())


def json_kind(s) -> Column:
    """'object' | 'array' | 'string' | 'scalar' | NULL (not valid JSON text)."""
    t = bare_literals_quoted(json_trimmed(s))
    # Keys are only needed when the variant parser rejects the text (duplicate keys); the CASE
    # evaluates them for those rows only, so valid answers are parsed once.
    parsed = document(t).isNotNull()
    keys = F.when(~parsed, F.json_object_keys(t))
    return kind_of(t, keys, parsed)


def kind_of(t: Column, keys: Column, parsed: Column) -> Column:
    """JSON kind from the trimmed text, whether it is a :func:`document`, and its object keys (needed where it is not: a
    variant rejects repeated keys, of which Python keeps the last)."""
    dup_keys = keys.isNotNull() & (F.size(keys) > F.size(F.array_distinct(keys)))
    first = F.substring(t, 1, 1)
    plain = first.isin("{", "[", '"') | t.rlike(r"^[-+0-9.eEa-z]+$")
    bare = t.isin("NaN", "Infinity", "-Infinity")
    ok = bare | (plain & (parsed | (dup_keys & one_document(t))))
    return (F.when(~F.coalesce(ok, F.lit(False)), F.lit(None).cast("string"))
            .when(first == "{", "object").when(first == "[", "array")
            .when(first == '"', "string").otherwise("scalar"))


def bare_boolean_confidence(t, doc) -> Column:
    """1.0 / 0.0 when the answer's own confidence is a JSON boolean (``float(True)``), else NULL. In an answer with repeated
    keys, which is no :func:`document`, the last one of the text counts."""
    own = F.try_variant_get(_c(doc), "$[0].confidence", "variant")
    last = F.regexp_extract(_c(t), r'(?s).*"confidence"[ \t\n\r]*:[ \t\n\r]*(true|false)\b', 1)
    word = F.when(_c(doc).isNull(), last).when(F.schema_of_variant(own) == "BOOLEAN", F.try_variant_get(own, "$", "string"))
    return F.when(word == "true", F.lit(1.0)).when(word == "false", F.lit(0.0))


def overflowing_confidence(text, doc) -> Column:
    """A number beyond the doubles, which ``float()`` reads as infinite and the parser renders as a quoted word."""
    number = F.schema_of_variant(F.try_variant_get(_c(doc), "$[0].confidence", "variant")) != "STRING"
    return F.when(number, F.trim(_c(text), F.lit('"')).try_cast("double"))


def py_list_text(arr: Column) -> Column:
    """Python ``repr`` of a list of plain strings: ``['a', 'b']``."""
    return F.concat(F.lit("["), F.array_join(F.transform(arr, lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "),
                    F.lit("]"))


def parse_float_text(t) -> Column:
    """Python ``float(text)``: NULL when Python would raise."""
    s = py_strip(_c(t))
    return F.when(s.rlike(FLOAT_TEXT), F.regexp_replace(s, "_", "").try_cast("double"))
