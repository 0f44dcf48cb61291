"""Golden cases from the reference docstrings and scheme texts for the scheme-table rules."""

from core_helpers import one_col
import pytest
from pyspark.sql import functions as F

from coderail.functions import scheme as S


def test_simplify_name_golden(spark):
    vals = ["2.0 a Vorkommen Medienkompetenz", "2.1.1 Zielkompetenz", ".1 Genauer Name", "3 DigComp"]
    assert one_col(spark, vals, S.simplify_name) == ["Vorkommen Medienkompetenz", "Zielkompetenz", "Genauer Name",
                                                      "DigComp"]


def test_simplify_name_protects_derived(spark):
    got = one_col(spark, ["_DERIVED_2.1 Berufliches Engagement"], lambda c: S.simplify_name(c, protect_derived=True))
    assert got == ["_DERIVED_Berufliches Engagement"]


def test_generate_key_golden(spark):
    vals = ["2.0a Digitale Medien", "2.0b Digitale Medien als Lernziel", "2.1.1 Organisatorische Kommunikation",
            "2.2.3  Organisieren, Schützen und Teilen digitaler Ressourcen"]
    assert one_col(spark, vals, S.generate_key) == ["Digitale_Medien", "Digitale_Medien_als_Lernziel",
                                                     "Organisatorische_Kommunikation",
                                                     "Organisieren_Sch_tzen_und_Teilen_digitaler_Ressourcen"]


def test_category_sort_key_golden(spark):
    vals = ["3.5", "3.1.2", "2.0b", "2.0.3.1", "", "Name", "2.0.1 Foo"]
    got = [tuple(r) for r in one_col(spark, vals, S.category_sort_key)]
    assert got == [(3, 5, 0, ""), (3, 1, 2, ""), (2, 0, 0, "b"), (2, 0, 3, ""), (999, 999, 999, ""),
                   (0, 0, 0, "Name"), (2, 0, 1, "")]


def test_parse_condition_golden(spark):
    vals = ["Ja (1) wenn min. eine der Kategorien 2.1.1-2.1.4 = 1",
            "Ja (1) wenn min. eine der Kategorien 2.0.3.1 & 2.0.3.2 = 1",
            "Wenn „Anbieter“ = 2\n Offen; -99",
            "Ja (1), nur, wenn auch 2.0.4 =1; Nein (0)",
            "Ja (1), Nein (0)",
            "Wenn a = 1 = 2"]
    got = one_col(spark, vals, S.parse_condition)
    r = [None if g is None else tuple(g) for g in got]
    assert r[0] == ("any_in_range", None, "2.1.1", "2.1.4", "1")
    assert r[1] is None
    assert r[2] == ("equals", "„anbieter“", None, None, "2\n offen; -99")
    assert r[3] is None and r[4] is None and r[5] is None
    assert one_col(spark, vals, S.condition_problem)[5] == "condition_unpacking"


def test_standardise_values(spark):
    vals = ["JA oder nein", "Offen", "A\n B \n\nC", "Seminar (1); Event (2); Event (2); -99", "a, b, a",
            "Ja (1) wenn x = 1"]
    got = one_col(spark, vals, S.standardise_values)
    assert got == ["Ja (1), Nein (0)", "offen", "A; B; C", "Seminar (1); Event (2); -99", "a, b", "Ja (1) wenn x = 1"]


def test_clean_values_fix_keeps_duplicates(spark):
    vals = ['"a; b;; a"', "Offen", "", "x wenn y"]
    assert one_col(spark, vals, S.clean_values) == ["a, b, a", "offen", "", "x wenn y"]


def test_values_format(spark):
    vals = ["Ja (1), Nein (0)", "offen", "Hochschule (1), externer Anbieter (2)", "A; B; -99", "wenn x", "-99", ""]
    assert one_col(spark, vals, S.values_format) == ["binary", "open", "numbered_choice", "letter_list",
                                                      "conditional", "comma_list", "invalid"]  # "-99" meets comma_list first


def test_allowed_codes(spark):
    got = one_col(spark, ["Ja (1), Nein (0)", "a (1), b (2), -99", "offen"], S.allowed_codes)
    assert [sorted(g) for g in got] == [["0", "1"], ["-99", "1", "2"], []]


def test_clean_examples_bullets(spark):
    df = spark.createDataFrame([("• a\n  \n· \"b\"",)], "e string")
    out = df.select(S.clean_examples(S.example_lines(F.col("e"))).alias("x")).first().x
    assert out == ["a", "'b'"]


def test_filter_categories_position_is_menu_order(spark):
    from coderail.operators.scheme import filter_categories
    rows = [("a", 1, "2.0.3 X"), ("a", 2, "1.1 Y"), ("a", 3, "2.0.3.1 Z"), ("a", 4, "Kein Nummer"), ("a", 5, "1.1a W"),
            ("b", 6, "3 V"), ("b", 7, "1 U")]
    df = spark.createDataFrame(rows, "scheme_id string, ordinal long, display_name string")
    got = {(r.scheme_id, r.pos): r.ordinal for r in filter_categories(df, position="pos").collect()}
    assert got == {("a", 0): 2, ("a", 1): 5, ("a", 2): 1, ("a", 3): 3, ("b", 0): 7, ("b", 1): 6}


def test_unique_keys_count_past_taken_names(spark):
    from coderail.operators.scheme import unique_keys

    def importer(keys):
        used = {}
        for k in keys:
            name, n = k, 0
            while name in used:
                n += 1
                name = f"{k}_{n}"
            used[name] = 1
        return list(used)
    cases = {"a": ["Foo", "Foo", "Foo_1"], "b": ["Foo_1", "Foo", "Foo", "Foo", "Foo_2", "Foo_2"], "c": ["p_1", "p_2", "p"],
             "d": ["x"] * 5 + ["y", "x_3", "x"], "e": ["Foo", "Foo_1", "Foo_1", "Foo_1_1", "Foo"]}
    rows = [(s, 10 * i, k) for s, ks in cases.items() for i, k in enumerate(ks)] + [("a", 99, "")]
    got = unique_keys(spark.createDataFrame(rows, "scheme_id string, ordinal long, key string")).orderBy("scheme_id", "ordinal").collect()
    for s, ks in cases.items():
        assert [r.key for r in got if r.scheme_id == s] == importer(ks)


def test_violations_keep_rows_without_names(spark):
    from coderail.operators.scheme import scheme_violations
    rows = [("a", 1, "K", "1.1 N", "c", ["e"], "v"), ("a", 2, "K", "2.1 N", None, ["e"], "v"), ("a", 3, "L", None, "c", None, "v"),
            ("a", 4, None, None, "c", ["e"], None), ("a", 5, None, "L", "c", ["e"], "v")]
    df = spark.createDataFrame(rows, "scheme_id string, ordinal long, key string, display_name string, criteria string, examples array<string>, values_text string")
    got = sorted((r.ordinal, r.rule) for r in scheme_violations(df).collect())
    assert got == [(2, "duplicate_name"), (2, "key_collision"), (2, "missing_criteria"), (3, "missing_examples"), (4, "missing_values"), (5, "duplicate_name")]


def test_load_scheme_refuses_a_foreign_structure(spark, tmp_path):
    from coderail.operators.scheme import SchemeStructureError, load_scheme
    (tmp_path / "s.json").write_text('{"foo": 1}\n')
    with pytest.raises(SchemeStructureError):
        load_scheme(spark, str(tmp_path / "s.json"))


def test_fix_scheme_cleans_every_field(spark):
    from coderail.operators.scheme import fix_scheme
    df = spark.createDataFrame([("a", 1, "2_0_Name", "2.0 Name", 'Kriterium:  a "b"', ["• x", '"y" '], "A; B;; -99")],
                               "scheme_id string, ordinal long, key string, display_name string, criteria string, examples array<string>, values_text string")
    r = fix_scheme(df).first()
    assert (r.display_name, r.simplified_name, r.criteria, r.examples, r.values_text) == ("2_0_Name", "2_0_Name", "a 'b'", ["x", "'y'"], "A, B, -99")


def test_examples_given_as_pairs(spark):
    df = spark.createDataFrame([([{"Begriffe": "a"}, {"x": "1", "y": "2"}],)], "e array<map<string,string>>")
    assert df.select(S.dict_examples(F.col("e")).alias("x")).first().x == ["Begriffe: a", "x: 1; y: 2"]
