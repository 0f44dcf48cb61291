"""Operator properties: dedupe is idempotent and first-wins, wide/long round trip, last result wins,
kappa is symmetric, unknown selections are skipped."""

from pyspark.sql import functions as F

from coderail.operators import joins, prep, results
from coderail.plans import stages as P
from core_helpers import SF_SMALL


def test_dedupe_first_wins_and_idempotent(spark):
    df = spark.createDataFrame([(3, "a", "x3"), (1, "a", "x1"), (2, "b", "y"), (4, None, "n1"), (5, None, "n2")],
                               "ordinal long, title string, d string")
    once = prep.dedupe_first(df, ["title"])
    got = sorted((r.title or "", r.d) for r in once.collect())
    assert got == [("", "n1"), ("a", "x1"), ("b", "y")]
    twice = prep.dedupe_first(once, ["title"])
    assert sorted(map(tuple, twice.collect()), key=str) == sorted(map(tuple, once.collect()), key=str)


def test_prepare_entries_requires_columns(spark):
    import pytest
    df = spark.createDataFrame([(1, "t")], "ordinal long, title string")
    with pytest.raises(prep.MissingColumnsError):
        prep.prepare_entries(df)


def test_recode_normalises_integral_floats(spark):
    df = spark.createDataFrame([(1, "1.0"), (2, "2"), (3, None), (4, "0")], "ordinal long, human_code string")
    got = {r.ordinal: (r.human_code, r.recoded) for r in prep.recode_invalid(df, flag="recoded").collect()}
    assert got == {1: ("1", False), 2: ("0", True), 3: ("0", True), 4: ("0", False)}


def test_wide_last_result_wins(spark):
    coded = spark.createDataFrame(
        [(1, 1, "t", "d  one", "a", "1", 0.5, "r1"), (2, 1, "t", "d two", "a", "Nein (0)", 0.125, "r2"),
         (1, 2, "t", "d one", "b", "ja", 0.9, "rb")],
        "ordinal long, cat_ordinal int, title string, description string, category string, ai_code string, "
        "confidence double, reasoning string")
    w = results.wide_results(coded, ["b", "a"]).collect()
    assert len(w) == 1
    r = w[0].asDict()
    assert list(r) == ["title", "description", "ai_a", "ai_b", "confidence_a", "confidence_b", "reasoning_a",
                       "reasoning_b"]
    assert (r["description"], r["ai_a"], r["confidence_a"], r["reasoning_a"], r["ai_b"]) == (
        "d one", "0", "0.12", "r2", "1")


def test_wide_long_round_trip(spark):
    coded = P.coded(spark, SF_SMALL)
    wide = results.wide_results(coded, P.CATEGORIES)
    back = wide.select("title", F.inline(F.array(*[F.struct(F.lit(c).alias("category"), F.col(f"ai_{c}").alias("ai"))
                                                     for c in P.CATEGORIES]))).filter(F.col("ai").isNotNull())
    from coderail.functions.text import normalise_code
    exp = coded.select("title", "category", normalise_code(F.col("ai_code")).alias("ai"))
    assert back.exceptAll(exp).count() == 0 and exp.exceptAll(back).count() == 0


def test_kappa_symmetric(spark):
    paired = results.paired_codes(P.coded(spark, SF_SMALL), P.human_long(spark, SF_SMALL))
    swapped = paired.select("ordinal", "category", F.col("human_code").alias("ai_code"), "confidence", "title",
                            F.col("ai_code").alias("human_code"))
    a = {r.category: r.kappa for r in results.agreement_kappa(paired).collect()}
    b = {r.category: r.kappa for r in results.agreement_kappa(swapped).collect()}
    assert a == b


def test_unknown_and_repeated_selections(spark):
    sel = spark.createDataFrame([(1, "quality"), (2, "toxic"), (3, "quality"), (4, "nope")], "ordinal int, key string")
    scheme = P.task_scheme(spark, SF_SMALL)
    assert [tuple(r) for r in joins.unknown_categories(sel, scheme).collect()] == [(4, "nope")]
    cats = {r.key: r.cat_ordinal for r in joins.selected_categories(sel, scheme).collect()}
    assert cats == {"quality": 1, "toxic": 2}


def test_build_tasks_nothing_selected(spark):
    sel = spark.createDataFrame([], "ordinal int, key string")
    t = joins.build_tasks(P.entries(spark, SF_SMALL), sel, P.task_scheme(spark, SF_SMALL))
    assert t.count() == 0


def test_wide_with_entries_equals_wide_from_coded(spark):
    from coderail.operators.results import wide_results
    from coderail.plans import stages as P
    from core_helpers import SF_SMALL
    coded, entries = P.coded(spark, SF_SMALL), P.entries(spark, SF_SMALL)
    a = wide_results(coded, P.CATEGORIES)
    b = wide_results(coded, P.CATEGORIES, entries=entries)
    assert a.columns == b.columns
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
