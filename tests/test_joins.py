"""Joins against brute-force Python models, including a title that holds a third of all code rows."""

from collections import Counter

from coderail.operators.joins import merge_codes, title_mismatch


def _left_join(entries, codes):
    out = []
    for o, t in entries:
        hits = [c for c in codes if c[0] == t]  # None == None: NULL titles match, as in pandas
        out += [(o, t, h[1] if h[1] is not None else "0") for h in hits] or [(o, t, "0")]
    return Counter(out)


def test_merge_codes_hot_title_and_nulls(spark):
    entries = [(i, f"t{i}") for i in range(60)] + [(100, None), (101, "hot")]
    codes = [("hot", str(i % 2)) for i in range(40)] + [(f"t{i}", "1" if i % 3 else None) for i in range(0, 80, 2)] \
        + [(None, "1"), ("t4", "0")]
    e = spark.createDataFrame(entries, "ordinal long, title string")
    c = spark.createDataFrame(codes, "title string, human_code_q string")
    got = Counter(tuple(r) for r in merge_codes(e, c).select("ordinal", "title", "human_code_q").collect())
    assert got == _left_join(entries, codes)


def test_title_mismatch_sets(spark):
    e = spark.createDataFrame([("a",), ("b",), (None,), ("",)], "title string")
    c = spark.createDataFrame([("b",), ("c",), ("c",), ("\u0001x",)], "title string")
    got = sorted(((r.side, r.title) for r in title_mismatch(e, c).collect()), key=lambda t: (t[0], str(t[1])))
    assert got == sorted([("missing_in_codes", "a"), ("missing_in_codes", None), ("missing_in_codes", ""),
                          ("extra_in_codes", "c"), ("extra_in_codes", "\u0001x")], key=lambda t: (t[0], str(t[1])))


def test_kappa_matches_brute_force_with_free_text_codes(spark):
    from coderail.operators.results import agreement_kappa
    pairs = [("q", h, a) for h, a in [("1", "1"), ("1", "0"), ("0", "0"), ("0", "vielleicht"), ("1", "1"),
                                      ("0", None), ("1", "x y")]] + [("t", "1", "1"), ("t", "1", "1")]
    df = spark.createDataFrame(pairs, "category string, human_code string, ai_code string")
    got = {r.category: (r.n_pairs, r.observed, r.expected, r.kappa) for r in agreement_kappa(df).collect()}
    for cat in ("q", "t"):
        rows = [(h, a) for c, h, a in pairs if c == cat]
        n = len(rows)
        po = sum(1 for h, a in rows if h is not None and h == a) / n
        codes = {h for h, _ in rows} | {a for _, a in rows}
        pe = sum(sum(1 for h, _ in rows if h == k) * sum(1 for _, a in rows if a == k)
                 for k in codes if k is not None) / (n * n)
        kappa = None if pe == 1 else round((po - pe) / (1 - pe), 4)
        assert got[cat] == (n, round(po, 4), round(pe, 4), kappa)


def test_run_progress_brute_force(spark):
    from coderail.operators.results import run_progress
    tasks = [(o, c) for o in range(7) for c in ("a", "b")] + [(1, "a")]          # one task listed twice
    coded = [(0, "a"), (0, "a"), (1, "a"), (2, "b"), (9, "a"), (3, "c")]         # repeats and strays
    t = spark.createDataFrame(tasks, "ordinal long, category string")
    c = spark.createDataFrame(coded, "ordinal long, category string")
    got = {r.category: (r.n_tasks, r.n_done, r.pct_done) for r in run_progress(t, c).collect()}
    done = set(coded)

    def fig(rows):
        n, d = len(rows), sum(1 for r in rows if r in done)
        return n, d, (d * 100 // n if n else 0)
    exp = {cat: fig([r for r in tasks if r[1] == cat]) for cat in ("a", "b")}
    exp["_overall"] = fig(tasks)
    assert got == exp


def test_merge_keeps_every_code_column(spark):
    from coderail.operators.joins import merge_codes
    e = spark.createDataFrame([(1, "a"), (2, "b")], "ordinal long, title string")
    c = spark.createDataFrame([(7, "a", "1", "x")], "ordinal long, title string, human_code string, coder string")
    got = sorted(tuple(r) for r in merge_codes(e, c).select("ordinal", "title", "ordinal_codes", "human_code", "coder").collect())
    assert got == [(1, "a", 7, "1", "x"), (2, "b", None, "0", None)]


def test_selection_by_simplified_name(spark):
    from coderail.operators.joins import selected_categories, unknown_categories
    scheme = spark.createDataFrame([(1, "k1", "Eins"), (2, "k2", "Zwei")], "ordinal int, key string, simplified_name string")
    sel = spark.createDataFrame([(1, "Zwei"), (2, "k1"), (3, "k2"), (4, "Drei")], "ordinal int, key string")
    assert sorted((r.cat_ordinal, r.key) for r in selected_categories(sel, scheme).collect()) == [(1, "k2"), (2, "k1")]
    assert [(r.ordinal, r.key) for r in unknown_categories(sel, scheme).collect()] == [(4, "Drei")]


def test_many_selected_categories_are_not_refused(spark):
    from coderail.operators.joins import build_tasks
    e = spark.createDataFrame([(1, "t")], "ordinal long, title string")
    n = 1200
    scheme = spark.createDataFrame([(i, f"k{i}", "d") for i in range(n)], "ordinal int, key string, display_name string")
    sel = spark.createDataFrame([(i, f"k{i}") for i in range(n)], "ordinal int, key string")
    assert build_tasks(e, sel, scheme, cat_cols=("display_name",)).count() == n
