"""Python string semantics expressed as Spark Column expressions.

Python's ``str.strip()`` / ``str.split()`` treat every Unicode whitespace character plus the
separators U+001C..U+001F as whitespace. Spark's ``trim`` only removes blanks and Java's ``\\s``
is ASCII unless the UNICODE_CHARACTER_CLASS flag ``(?U)`` is on, which still lacks U+001C..U+001F.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java regex character class equal to Python's str.isspace() set (used with the (?U) flag).
WS = r"[\s\x1c-\x1f]"
_STRIP_RE = rf"(?U)^{WS}+|{WS}+$"
_RUN_RE = rf"(?U){WS}+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The characters for which Python's str.isspace() is true (the whole set, 29 of them).
PY_WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
                 "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def py_strip(c) -> Column:
    """``str.strip()``: remove Unicode whitespace at both ends; NULL stays NULL.

    ``btrim`` with the explicit character set: a scan from both ends, no regular expression."""
    return F.btrim(_col(c), F.lit(PY_WHITESPACE))


def py_split_ws(c) -> Column:
    """``str.split()`` without arguments: tokens between whitespace runs (no empty tokens)."""
    s = py_strip(c)
    return F.when(s == "", F.array().cast("array<string>")).otherwise(F.split(s, _RUN_RE))


def first_token(c) -> Column:
    """``s.split()[0]`` or NULL when the text has no token."""
    return F.try_element_at(py_split_ws(c), F.lit(1))


def collapse_whitespace(c) -> Column:
    """``' '.join(s.replace('\\n', ' ').split())``: one blank between tokens, no outer blanks."""
    return F.regexp_replace(py_strip(c), _RUN_RE, " ")


def format_2dp(c) -> Column:
    """``f"{x:.2f}"`` for values in [0, 1]: round-half-even on the binary value (``format_number``).

    ``format_number`` adds thousands separators, which never occur for confidences (clamped to [0, 1]).
    """
    return F.format_number(_col(c).cast("double"), 2)


# The answer spellings that the reference maps to the codes "1" and "0".
YES_SPELLINGS = ["ja", "ja (1)", "(1)", "1"]
NO_SPELLINGS = ["nein", "nein (0)", "(0)", "0"]


def normalise_code(c) -> Column:
    """strip + lower-case; yes-spellings -> "1", no-spellings -> "0", anything else stays lower-cased."""
    v = F.lower(py_strip(_col(c)))
    return F.when(v.isin(*YES_SPELLINGS), F.lit("1")).when(v.isin(*NO_SPELLINGS), F.lit("0")).otherwise(v)


# Confidence bands (code wins over the docstring wording).
LOW_BELOW = 0.33
MEDIUM_BELOW = 0.67


def confidence_level(c) -> Column:
    x = _col(c)
    return F.when(x < LOW_BELOW, "low").when(x < MEDIUM_BELOW, "medium").otherwise("high")
