"""Python string semantics and the golden literals of the fixtures."""

from core_helpers import one_col

from coderail.functions import text as T

WS_SAMPLES = ["  a  ", " a ", "\x1ca\x1f", "\ta b\n", "", "   ", "a​b", "　x　", None]


def test_py_strip_matches_python(spark):
    got = one_col(spark, WS_SAMPLES, T.py_strip)
    assert got == [None if s is None else s.strip() for s in WS_SAMPLES]


def test_collapse_whitespace_matches_python(spark):
    vals = ["a \n b  c", "  x\t\ty  ", "", "\x1c", "one"]
    got = one_col(spark, vals, T.collapse_whitespace)
    assert got == [" ".join(v.replace("\n", " ").split()) for v in vals]


def test_split_ws_matches_python(spark):
    vals = ["a  b c", "   ", "x"]
    got = one_col(spark, vals, T.py_split_ws)
    assert [list(g) for g in got] == [v.split() for v in vals]


def test_format_confidence_half_even(spark):
    vals = [0.125, 0.375, 0.0, 1.0, 0.005, 0.015, 0.67]
    got = one_col(spark, vals, T.format_2dp, "x double")
    assert got == [f"{v:.2f}" for v in vals]


def test_normalise_code_golden(spark):
    vals = ["Ja (1)", "(0)", "Hybrid", " JA ", "nein", "1", "0", "Nein (0)", "-99", "None"]
    got = one_col(spark, vals, T.normalise_code)
    assert got == ["1", "0", "hybrid", "1", "0", "1", "0", "0", "-99", "none"]


def test_confidence_level_golden(spark):
    got = one_col(spark, [0.329, 0.33, 0.669, 0.67, 0.0, 1.0], T.confidence_level, "x double")
    assert got == ["low", "medium", "medium", "high", "low", "high"]
