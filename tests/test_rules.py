"""Derived categories against a brute-force Python model on small hand-made fixtures."""

from coderail.operators.rules import derive_any_in_range


def _num(s):
    try:
        return [int(x) for x in s.split(".")]
    except (ValueError, AttributeError):
        return None


def _brute(codes, rules):
    """Levels in order; a text gets every derived category of a level, "1" when any of its codes at
    the depth of the range ends lies in [start, end] with the rule's code."""
    docs = sorted({d for d, _, _ in codes})
    current = list(codes)
    out = []
    for lv in sorted({r[0] for r in rules}):
        level = []
        for _, number, start, end, code in [r for r in rules if r[0] == lv]:
            s, e = _num(start), _num(end)
            for d in docs:
                hit = any(dd == d and c == code and (n := _num(num)) is not None and len(n) == len(s) and s <= n <= e
                          for dd, num, c in current)
                level.append((d, number, "1" if hit else "0", lv))
        out += level
        current += [(d, n, c) for d, n, c, _ in level]
    return sorted(out)


def test_any_in_range_matches_brute_force(spark):
    codes = [
        (1, "2.1.1", "1"), (1, "2.1.9", "0"), (1, "2.2.1", "0"), (1, "3.1", "0"),
        (2, "2.1.4", "0"), (2, "2.2.3", "1"), (2, "2.1", "1"),      # 2.1 is depth 2: not in 2.1.1-2.1.4
        (3, "2.1.5", "1"), (3, "3.5", "1"), (3, "x.y", "1"),        # 2.1.5 is past the end
        (4, "1.1", "0"),                                              # no code in any range
        (5, "2.10.1", "1"), (5, "2.2.2", "-99"),                      # 2.10 > 2.2 numerically
    ]
    rules = [(1, "2.1", "2.1.1", "2.1.4", "1"), (1, "2.2", "2.2.1", "2.2.3", "1"),
             (1, "3", "3.1", "3.5", "1"), (1, "2.x", "2.3.1", "2.12.1", "1"),
             (2, "2.0.4", "2.1", "2.2", "1"), (2, "9", "3", "3", "1")]
    cdf = spark.createDataFrame(codes, "doc_id long, number string, code string")
    rdf = spark.createDataFrame(rules, "level int, number string, range_start string, range_end string, code string")
    got = sorted(tuple(r) for r in derive_any_in_range(cdf, rdf).collect())
    assert got == _brute(codes, rules)


SCHEME = "ordinal long, display_name string, condition struct<type:string, reference:string, range_start:string, range_end:string, value:string>"


def test_rules_from_parsed_conditions(spark):
    from pyspark.sql import functions as F

    from coderail.functions.scheme import parse_condition
    from coderail.operators.rules import rules_from_conditions
    rows = [(1, "2.0.4 Ziel", "Ja (1) wenn min. eine der Kategorien 2.1-2.2 = 1\noder Nein (0)"),
            (2, "2.1 Beruf", "Ja (1) wenn min. eine der Kategorien 2.1.1-2.1.4 = 1\n oder Nein (0)"),
            (3, "2.2 Lehre", "Ja (1) wenn min. eine der Kategorien 2.2.1-2.2.3 = 1"),
            (4, "1.0.4 Name", "Wenn \u201e1.2. Anbieter =1\u201c\nOffen; -99"), (5, "3.1 Frei", "offen")]
    df = spark.createDataFrame(rows, "ordinal long, display_name string, v string").withColumn("condition", parse_condition(F.col("v")))
    ranges, equals = rules_from_conditions(df)
    assert sorted(map(tuple, ranges.collect())) == [(1, "2.1", "2.1.1", "2.1.4", "1"), (1, "2.2", "2.2.1", "2.2.3", "1"), (2, "2.0.4", "2.1", "2.2", "1")]
    assert equals == [("1.0.4", "anbieter", "1")]
    codes = [(1, "2.1.3", "1"), (1, "2.2.1", "0"), (2, "2.1.3", "0")]
    got = derive_any_in_range(spark.createDataFrame(codes, "doc_id long, number string, code string"), ranges)
    assert sorted((r.doc_id, r.number, r.code) for r in got.collect()) == [
        (1, "2.0.4", "1"), (1, "2.1", "1"), (1, "2.2", "0"), (2, "2.0.4", "0"), (2, "2.1", "0"), (2, "2.2", "0")]


def test_conditions_in_a_circle_are_refused(spark):
    import pytest

    from coderail.operators.rules import RuleCycleError, rules_from_conditions
    rows = [(1, "2.1 A", ("any_in_range", None, "2.2", "2.3", "1")), (2, "2.2 B", ("any_in_range", None, "2.1", "2.1", "1"))]
    with pytest.raises(RuleCycleError):
        rules_from_conditions(spark.createDataFrame(rows, SCHEME))
