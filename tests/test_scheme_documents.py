"""Schemes as whole documents: structure checks, document order, types, round trip, and the flat form beside it."""

import json

import pytest

from coderail.operators import scheme as OS
from coderail.sources import scheme_documents as D

SOUND = {"coding_scheme": {"version": "2.0", "categories": {
    "Zeit": {"display_name": "1.1 Zeit", "simplified_name": "Zeit", "criteria": "wann {x}", "examples": ["z.B. \"früh\"", 3], "values": "offen; -99"},
    "Anbieter": {"display_name": "1.0 Anbieter", "criteria": "", "examples": [], "values": "Uni (1), andere (2)",
                 "condition": {"type": "equals", "reference": "zeit", "value": "1"}},
    "10": {"criteria": "c", "examples": ["a\nb"], "values": "Ja (1), Nein (0)"}}}}

BROKEN = {"invalid_json": "{'a': 1", "root_not_object": "[1, 2]", "missing_root": '{"scheme": {}}', "coding_scheme_not_object": '{"coding_scheme": "x"}',
          "missing_version": '{"coding_scheme": {"categories": {}}}', "missing_categories": '{"coding_scheme": {"version": "1.0"}}',
          "categories_not_object": '{"coding_scheme": {"version": "1.0", "categories": [{"key": "a"}]}}'}


def test_each_structure_check_has_its_own_error(spark, tmp_path):
    docs = spark.createDataFrame([*BROKEN.items(), ("sound", json.dumps(SOUND)), ("twice", '{"coding_scheme": {"version": "1", "version": "2"}}')],
                                 "scheme_id string, document string")
    found = dict(D.structure_problems(docs).collect())
    assert found == {**{k: k for k in BROKEN}, "twice": "invalid_json"}
    for rule, text in BROKEN.items():
        (tmp_path / rule).mkdir()
        (tmp_path / rule / "scheme.json").write_text(text)
        with pytest.raises(OS.SchemeStructureError, match=D.STRUCTURE[rule].replace("'", ".")):
            OS.load_scheme(spark, str(tmp_path / rule))


@pytest.mark.parametrize("indent", [None, 2])
def test_documents_of_users_load_in_document_order(spark, tmp_path, indent):
    (tmp_path / "mine.json").write_text(json.dumps(SOUND, indent=indent, ensure_ascii=False))
    got = OS.load_scheme(spark, str(tmp_path)).orderBy("ordinal").collect()
    want = SOUND["coding_scheme"]["categories"]
    assert [(r.scheme_id, r.version, r.ordinal, r.key) for r in got] == [("mine", "2.0", i, k) for i, k in enumerate(want)]
    for row, category in zip(got, want.values()):
        assert (row.display_name, row.criteria, row.values_text) == (category.get("display_name"), category["criteria"], category["values"])
        assert row.examples == [str(e) for e in category["examples"]] and row.problem is None
    assert got[1].condition.asDict() == {"type": "equals", "reference": "zeit", "range_start": None, "range_end": None, "value": "1"}


def test_assemble_then_load_gives_the_document_back(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps(SOUND))
    rows = OS.load_scheme(spark, str(tmp_path / "in"))
    again = OS.load_scheme(spark, OS.assemble_documents(rows, str(tmp_path / "out"), version="2.0"))
    assert sorted(map(str, again.collect())) == sorted(map(str, rows.collect()))
    (file,) = (tmp_path / "out" / "scheme_id=a").glob("*.txt")
    document = json.loads(file.read_text())
    assert document["coding_scheme"]["version"] == "2.0" and list(document["coding_scheme"]["categories"]) == ["Zeit", "Anbieter", "10"]
    assert document["coding_scheme"]["categories"]["Anbieter"] == SOUND["coding_scheme"]["categories"]["Anbieter"]
    # the flat form of the same rows loads to the same categories
    flat = OS.load_scheme(spark, OS.assemble_scheme(rows, str(tmp_path / "flat"), version="2.0"))
    cols = ["scheme_id", "ordinal", "key", "criteria", "examples", "values_text", "condition"]
    assert sorted(map(str, flat.select(cols).collect())) == sorted(map(str, rows.select(cols).collect()))


def test_wrong_types_are_rules_of_their_own(spark):
    raw = {"a": "text", "b": {"criteria": 1, "examples": "x", "values": None}, "c": [], "d": {}, "e": {"criteria": "", "examples": [], "values": ""},
           "f": {"display_name": ["x"], "criteria": None, "examples": {}, "values": True}, "g": None}
    docs = spark.createDataFrame([("s", json.dumps({"coding_scheme": {"version": 1, "categories": raw}}))], "scheme_id string, document string")
    rows = D.categories(docs)
    keys = {r.ordinal: r.key for r in rows.collect()}
    got = sorted((keys[r.ordinal], r.rule) for r in OS.scheme_violations(rows).collect())
    assert got == sorted([("a", "category_not_object"), ("b", "criteria_not_string"), ("b", "examples_not_list"), ("b", "values_not_string"),
                          ("c", "category_not_object"), ("d", "missing_criteria"), ("d", "missing_examples"), ("d", "missing_values"),
                          ("f", "display_name_not_string"), ("f", "criteria_not_string"), ("f", "examples_not_list"), ("f", "values_not_string"),
                          ("g", "category_not_object")])
    assert {r.version for r in rows.collect()} == {"1"}


def test_a_category_carries_no_list_of_all_keys(spark):
    """Places in the document come from the generator; a list of all keys beside each category would be quadratic."""
    import contextlib
    import io
    keys = [f"k{(i * 7919) % 20011}" for i in range(20000)] + ["\U0001f600", "￿", "ü\"\n", ""]
    text = json.dumps({"coding_scheme": {"version": "1", "categories": {k: {"criteria": k, "examples": [1.50, None], "values": "v"} for k in keys}}})
    rows = D.categories(spark.createDataFrame([("s", text)], "scheme_id string, document string"))
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        rows.explain(True)
    assert "array_position" not in plan.getvalue() and "json_object_keys" not in plan.getvalue()
    got = sorted((r.ordinal, r.key, r.criteria, r.examples[0]) for r in rows.collect())
    assert got == [(i, k, k, "1.5") for i, k in enumerate(keys)]
