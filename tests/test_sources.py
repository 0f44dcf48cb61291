"""Entry readers: distinct errors for a missing file, an empty file and an unsupported format."""

import pytest

from coderail.sources.entries import EmptyDataError, load_entries


def test_missing_empty_and_xlsx(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(EmptyDataError):
        load_entries(spark, str(tmp_path / "empty.csv"))
    with pytest.raises(FileNotFoundError):
        load_entries(spark, str(tmp_path / "nope.csv"))
    with pytest.raises(ValueError, match="xlsx"):
        load_entries(spark, str(tmp_path / "x.xlsx"))


def test_csv_keeps_quoted_empty_and_multiline(spark, tmp_path):
    p = tmp_path / "e.csv"
    p.write_text('ordinal,title,description\n1,"a ""q""","line1\nline2"\n2,"",\n')
    rows = load_entries(spark, str(p)).orderBy("ordinal").collect()
    assert [(r.ordinal, r.title, r.description) for r in rows] == [(1, 'a "q"', "line1\nline2"), (2, "", None)]


def test_latest_results_prunes_partitions(spark, tmp_path):
    from pyspark.sql import functions as F

    from coderail.sources.results_io import latest_results, read_results, write_results
    base = str(tmp_path / "results")
    for rid in ("20260101_000000", "20260301_120000", "20260201_000000"):
        write_results(spark.range(5).withColumn("v", F.lit(rid)), base, rid)
    out = latest_results(read_results(spark, base))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan and "Subquery" in plan
    assert {(r.v, r.run_id) for r in out.collect()} == {("20260301_120000", "20260301_120000")}
    assert out.count() == 5
    empty = spark.createDataFrame([], "id long, run_id string")
    assert latest_results(empty).count() == 0


def test_columns_come_by_header_name(spark, tmp_path):
    from coderail.operators.prep import MissingColumnsError
    (tmp_path / "swapped.csv").write_text("ordinal,description,title,lang\n5,d,t,de\n")
    r = load_entries(spark, str(tmp_path / "swapped.csv")).first()
    assert (r.ordinal, r.title, r.description, r.lang) == (5, "t", "d", "de")
    (tmp_path / "bare.csv").write_text("title,description\na,b\nc,d\n")
    rows = load_entries(spark, str(tmp_path / "bare.csv")).orderBy("ordinal").collect()
    assert [(r.title, r.description) for r in rows] == [("a", "b"), ("c", "d")]
    (tmp_path / "none.csv").write_text("title,text\na,b\n")
    with pytest.raises(MissingColumnsError):
        load_entries(spark, str(tmp_path / "none.csv"))


def test_runs_with_other_categories_and_repeated_ids(spark, tmp_path):
    from coderail.sources.results_io import new_run_id, read_results, write_results
    base = str(tmp_path / "runs")
    one = spark.createDataFrame([("t", "1")], "title string, ai_quality string")
    two = spark.createDataFrame([("t", "0", "1")], "title string, ai_quality string, ai_length string")
    write_results(one, base, "a")
    write_results(two, base, "b")
    write_results(two, base, "b")
    assert sorted((r.run_id, r.ai_quality, r.ai_length) for r in read_results(spark, base).collect()) == [("a", "1", None), ("b", "0", "1")]
    assert read_results(spark, base, "a").columns == ["title", "ai_quality", "run_id"]
    assert new_run_id() != new_run_id()


def test_files_of_a_folder_go_by_their_own_headers(spark, tmp_path):
    (tmp_path / "a one.csv").write_text("title,description\nt1,d1\n\"t2\",\"d\n2\"\n")
    (tmp_path / "b+2.csv").write_text("description,title\nd3,t3\n")
    (tmp_path / "c%41.csv").write_text("ordinal,title,description,lang\n7,t4,d4,de\n")
    (tmp_path / "d.csv").write_text("title,description\nt5,d5\n")
    (tmp_path / "e.csv").write_text("")
    rows = load_entries(spark, str(tmp_path), fmt="csv").collect()
    assert sorted((r.title, r.description, r.lang) for r in rows) == [
        ("t1", "d1", None), ("t2", "d\n2", None), ("t3", "d3", None), ("t4", "d4", "de"), ("t5", "d5", None)]


def test_latest_result_file_over_both_names(spark, tmp_path):
    import os

    from coderail.sources.results_io import latest_result_file, result_files
    base = tmp_path / "data" / "results"
    assert latest_result_file(spark, str(base)).count() == 0
    base.mkdir(parents=True)
    assert latest_result_file(spark, str(base), schema="title string").columns == ["title"]
    for at, (name, v) in enumerate([("results_9.csv", "old"), ("ai_coded_results_2.csv", "new"), ("results_1.csv", "newest"),
                                    ("my_results_3.csv", "foreign"), (".results_4.csv", "hidden"), ("results.csv", "no name")]):
        (base / name).write_text(f"title,ai_quality\n{v},1\n")
        os.utime(base / name, (1_700_000_000 + at, 1_700_000_000 + at))
    got = latest_result_file(spark, str(base))
    assert [tuple(r) for r in got.collect()] == [("newest", "1")] and len(got.inputFiles()) == 1
    # A folder of part files counts as one result, as new as its newest part; its own columns come with it.
    spark.createDataFrame([("t", 1), ("u", 2)], "title string, ai_toxic int").repartition(2).write.parquet(str(base / "ai_coded_results_0.parquet"))
    assert sorted(tuple(r) for r in latest_result_file(spark, str(base) + "/").collect()) == [("t", 1), ("u", 2)]
    files = {r["name"]: r["n_files"] for r in result_files(spark, "file:" + str(base)).collect()}
    assert files == {"results_9.csv": 1, "ai_coded_results_2.csv": 1, "results_1.csv": 1, "ai_coded_results_0.parquet": 2}
    same = 1_800_000_000_000
    for name in ("results_5.csv", "results_6.csv"):
        (base / name).write_text(f"title\n{name}\n")
        os.utime(base / name, ns=(same * 10**6, same * 10**6))
    assert latest_result_file(spark, str(base)).first()["title"] == "results_6.csv"
    assert latest_result_file(spark, str(base), names=["my_*"]).first()["title"] == "foreign"
