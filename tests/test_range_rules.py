"""Range rules of many schemes against a brute-force model."""

import random

import pytest

from coderail.operators.range_rules import FAN, covered, derive_ranges, with_levels
from coderail.operators.rules import RuleCycleError

RULES = "scheme_id long, number string, range_start string, range_end string, code string"


def num(s):
    try:
        return [int(x) for x in s.split(".")]
    except (ValueError, AttributeError):
        return None


def covers(rule, number):
    n, a, b = num(number), num(rule[2]), num(rule[3])
    return bool(n and a and b) and len(a) == len(b) == len(n) and a <= n <= b


def brute(codes, rules):
    out = []
    for scheme in {r[0] for r in rules}:
        own = [r for r in rules if r[0] == scheme]
        needs = {r[1]: [d[1] for d in own if covers(r, d[1])] for r in own}
        level = {}

        def of(n):
            if n not in level:
                level[n] = 1 + max((of(d) for d in needs[n]), default=0)
            return level[n]
        for doc in {c[1] for c in codes if c[0] == scheme}:
            now = [(c[2], c[3]) for c in codes if c[:2] == (scheme, doc)]
            for r in sorted(own, key=lambda r: of(r[1])):
                code = "1" if any(covers(r, n) and c == r[4] for n, c in now) else "0"
                now.append((r[1], code))
                out.append((scheme, doc, r[1], code, level[r[1]]))
    return sorted(out)


def test_many_schemes_equal_brute_force(spark):
    rng = random.Random(4)
    rules, codes = [], []
    for s in range(12):
        for k in range(15):
            a, b = sorted(rng.randint(1, 8) for _ in range(2))  # 9 is for the derived categories
            shape = rng.choice(["{0}.{1}.%d", "%d.{0}", "{0}.%d", "7.%d"])
            shape = shape.format(rng.randint(1, 3), rng.randint(1, 3))
            if rng.random() < 0.4 and k:
                lo, hi = sorted(rng.randint(0, k - 1) for _ in range(2))
                rules.append((s, f"9.{k}", f"9.{lo}", f"9.{hi}", rng.choice("01")))
            else:
                rules.append((s, f"9.{k}", shape % a, shape % b, rng.choice(["0", "1", "1", "2"])))
        for d in range(6):
            for _ in range(rng.randint(1, 8)):
                n = ".".join(str(rng.randint(1, 12 if i else 3)) for i in range(rng.randint(1, 3)))
                codes.append((s, d, rng.choice([n, n, n, "x", "7.3", "1.2.y"]), rng.choice("0012")))
    rules += [(50, "1.1", "x", "2", "1"), (50, "1.2", "3.1", "2.9", "1"), (50, "1.3", "1.1.1", "2.2", "1")]
    codes += [(50, 1, "2.2", "1"), (99, 1, "1.1", "1")]
    got = derive_ranges(spark.createDataFrame(codes, "scheme_id long, doc_id long, number string, code string"), spark.createDataFrame(rules, RULES))
    assert sorted(tuple(r) for r in got.collect()) == brute(codes, rules)


def test_bins_find_what_the_ranges_cover(spark):
    """Ranges of one number up to several times FAN * FAN, across and along prefixes."""
    rng = random.Random(8)
    rules = []
    for i in range(60):
        span = rng.choice([0, 1, FAN - 1, FAN, FAN + 1, 5 * FAN, FAN * FAN * 3])
        a = rng.randint(0, 2000)
        rules.append((1, f"r{i}", *rng.choice([(f"{a}", f"{a + span}"), (f"1.{a}", f"1.{a + span}"), (f"1.{a}.7", f"1.{a + span}.2"), (f"{a}.3", f"{a + 1}.1")]), "1"))
    numbers = [(1, ".".join(str(x) for x in n)) for n in [*[(rng.randint(0, 15000),) for _ in range(60)], *[(1, rng.randint(0, 15000)) for _ in range(60)],
                                                         *[(rng.randint(0, 2500), rng.randint(0, 9)) for _ in range(60)], *[(1, rng.randint(0, 3000), rng.randint(0, 9)) for _ in range(60)]]]
    got = covered(spark.createDataFrame(numbers, "scheme_id long, number string"), spark.createDataFrame(rules, RULES))
    want = {(1, n, r[1]) for _, n in numbers for r in rules if covers(r, n)}
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want and len(want) > 100


def test_circles_are_refused_and_long_rule_tables_are_not_collected(spark):
    with pytest.raises(RuleCycleError):
        with_levels(spark.createDataFrame([(1, "2.1", "2.2", "2.3", "1"), (1, "2.2", "2.1", "2.1", "1")], RULES))
    chain = [(s, f"5.{i}", f"5.{i - 1}", f"5.{i - 1}", "1") for s in range(100) for i in range(1, 11)]
    got = with_levels(spark.createDataFrame(chain, RULES)).groupBy("level").count().collect()
    assert sorted((r["level"], r["count"]) for r in got) == [(i, 100) for i in range(1, 11)]
