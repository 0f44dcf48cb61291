"""Skew-safe ranking equals the window rank, also when one group holds most rows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from coderail.operators.ranking import rank_within


def test_rank_within_matches_window_with_hot_group(spark):
    # group "hot" holds 3000 of 3600 rows; 60 small groups of 10
    rows = [("s", "hot", i) for i in range(3000)] + [("s", f"k{i % 60}", 10000 + i) for i in range(600)]
    df = spark.createDataFrame(rows, "scheme_id string, key string, ordinal long")
    got = rank_within(df, ["scheme_id", "key"], "ordinal", out="r", num_partitions=7)
    exp = df.withColumn("r", F.row_number().over(Window.partitionBy("scheme_id", "key").orderBy("ordinal")) - 1)
    assert got.count() == df.count()
    assert got.exceptAll(exp.select(*got.columns)).count() == 0
    # the hot group really was split over several partitions
    parts = df.repartitionByRange(7, "scheme_id", "key", "ordinal").filter(F.col("key") == "hot") \
        .select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts > 1


def test_rank_within_null_group(spark):
    df = spark.createDataFrame([(None, 3), (None, 1), ("a", 2)], "g string, o long")
    got = {(r.g, r.o): r.r for r in rank_within(df, ["g"], "o", out="r", num_partitions=2).collect()}
    assert got == {(None, 1): 0, (None, 3): 1, ("a", 2): 0}


def test_rank_within_default_partitioning(spark):
    # no explicit count: AQE may coalesce the ranges; positions must still be exact
    rows = [("s", "hot", i) for i in range(2000)] + [("t", f"k{i % 13}", i) for i in range(260)]
    df = spark.createDataFrame(rows, "scheme_id string, key string, ordinal long")
    got = rank_within(df, ["scheme_id", "key"], "ordinal", out="r")
    exp = df.withColumn("r", F.row_number().over(Window.partitionBy("scheme_id", "key").orderBy("ordinal")) - 1)
    assert got.exceptAll(exp.select(*got.columns)).count() == 0 and got.count() == df.count()


def test_rank_within_many_groups_with_nulls(spark):
    rows = [(None if i % 5 == 0 else f"g{i % 3}", "x" if i % 2 else None, i) for i in range(400)]
    df = spark.createDataFrame(rows, "a string, b string, o long")
    got = rank_within(df, ["a", "b"], "o", out="r", num_partitions=3).collect()
    exp = {(r.a, r.b, r.o): r.r for r in
           df.withColumn("r", F.row_number().over(Window.partitionBy("a", "b").orderBy("o")) - 1).collect()}
    assert len(got) == len(rows) and {(r.a, r.b, r.o): r.r for r in got} == exp


def test_one_plan_without_python_and_without_counting_first(spark):
    df = spark.createDataFrame([("s", "hot", i) for i in range(50)], "scheme_id string, key string, ordinal long")
    plan = rank_within(df, ["scheme_id", "key"], "ordinal", out="r")._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "Python" not in plan and "Pandas" not in plan


def test_rows_of_equal_order_and_no_scheme_stay_single(spark):
    from coderail.operators.scheme import unique_keys
    rows = [(1, 1, "Foo", "a"), (1, 2, "Foo", "b"), (1, 2, "Foo", "c"), (1, 3, "Foo_1", "d"), (None, 1, "Foo", "e"), (None, 1, "Foo", "f"), (None, 2, "Foo_1", "g"), (1, 4, "", "h")]
    got = unique_keys(spark.createDataFrame(rows, "scheme_id long, ordinal long, key string, v string")).collect()
    assert sorted(r.v for r in got) == list("abcdefg")
    assert sorted(r.key for r in got if r.scheme_id == 1) == ["Foo", "Foo_1", "Foo_1_1", "Foo_2"]
    assert sorted(r.key for r in got if r.scheme_id is None) == ["Foo", "Foo_1", "Foo_1_1"]
