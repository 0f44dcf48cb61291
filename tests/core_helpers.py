"""Helpers of the core tests; a module of its own name, as every test folder may have a conftest."""

SF_SMALL = "/root/testdata/sf0.001"


def one_col(spark, values, expr, schema="s string"):
    """Evaluate a Column expression over a list of single values; returns the results in order."""
    from pyspark.sql import functions as F
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, {schema}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col(schema.split()[0]))).collect()]
