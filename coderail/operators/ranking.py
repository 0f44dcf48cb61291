"""Position of a row inside its group, robust to a group holding a large share of all rows.

A ``row_number()`` window sends each group whole to one task. Here the rows are range-partitioned
by (group, order): sampled bounds split a hot group over many tasks. A window per (partition, group)
numbers the rows where they are; a group continuing from earlier partitions then adds the row count
it has there. One plan for every input: nothing is counted first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir


def rank_within(df: DataFrame, group: Sequence[str], order: str, out: str = "rank",
                num_partitions: int | None = None) -> DataFrame:
    """Adds ``out`` = 0-based position of the row in its ``group`` by ``order`` (ties in any order)."""
    spark = df.sparkSession
    group = list(group)
    s = df.repartitionByRange(num_partitions, *group, order) if num_partitions else df.repartitionByRange(*group, order)
    # The partition numbers are frozen by a reliable checkpoint in the shared folder: a recomputation
    # would otherwise be free to place rows with equal keys differently.
    shared_dir(spark)
    placed = s.withColumn("_pid", F.spark_partition_id()).checkpoint()
    counts = placed.groupBy("_pid", *group).agg(F.count(F.lit(1)).alias("_cnt"))
    earlier = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", *group, F.coalesce(F.sum("_cnt").over(earlier), F.lit(0)).alias("_off"))
    local = placed.withColumn("_lrank", F.row_number().over(Window.partitionBy("_pid", *group).orderBy(order)) - 1)
    same = F.lit(True)
    for c in ("_pid", *group):
        same &= F.col(f"l.{c}").eqNullSafe(F.col(f"o.{c}"))
    return (local.alias("l").join(offsets.alias("o"), same)
            .select(*[F.col(f"l.{c}") for c in df.columns], (F.col("_lrank") + F.col("_off")).alias(out)))
