"""Result runs: one partition per run (``run_id`` = %Y%m%d_%H%M%S), newest run by partition pruning; result files by
name and modification time."""

from __future__ import annotations

import posixpath
import re
from collections.abc import Sequence
from datetime import datetime
from urllib.parse import urlparse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .entries import read_by_extension

# Names of result files, those of runs and those of the web form.
RESULT_NAMES = ("ai_coded_results_*", "results_*")

# Microseconds keep two runs of one second apart; ids still sort in time order.
RUN_ID_FORMAT = "%Y%m%d_%H%M%S_%f"


def new_run_id(now: datetime | None = None) -> str:
    return (now or datetime.now()).strftime(RUN_ID_FORMAT)


def write_results(df: DataFrame, base: str, run_id: str | None = None, fmt: str = "parquet") -> str:
    """Writes one run to its own folder below ``base`` (``run_id=...``); returns the run id. Writing a
    run again replaces it and leaves the other runs alone."""
    rid = run_id or new_run_id()
    df.drop("run_id").write.mode("overwrite").format(fmt).save(f"{base.rstrip('/')}/run_id={rid}")
    return rid


def latest_results(runs: DataFrame, run_col: str = "run_id") -> DataFrame:
    """Rows of the newest run (run ids sort in time order); an empty table gives nothing.

    The newest id is a scalar subquery, not a join: on a table partitioned by ``run_id`` it becomes a
    partition filter evaluated at run time (``PartitionFilters: run_id = Subquery``), so only the
    newest run's files are read, and the subquery itself reads partition values only."""
    newest = runs.select(F.max(run_col)).scalar()
    return runs.filter(F.col(run_col) == newest)


def read_results(spark: SparkSession, base: str, run_id: str | None = None) -> DataFrame:
    """All runs with the columns of all of them (runs may code different categories), or one run with its own."""
    if run_id is None:
        return spark.read.option("mergeSchema", True).parquet(base).withColumn("run_id", F.col("run_id").cast("string"))
    return spark.read.parquet(f"{base.rstrip('/')}/run_id={run_id}").withColumn("run_id", F.lit(run_id))


def result_files(spark: SparkSession, folder: str, names: Sequence[str] = RESULT_NAMES) -> DataFrame:
    """Result files of a folder: ``(name, modified, n_bytes, n_files)`` of the entries that have one of the names (``*``
    stands for anything). An entry is a file or a folder of part files, as Spark writes them; a folder is as new as its
    newest part. Hidden files do not count. A folder that does not exist holds none.

    The listing is Spark's own (spread over tasks where it is long); no file is opened, as their content is not selected."""
    inside = posixpath.normpath(urlparse(folder).path).strip("/")
    wanted = "|".join(".*".join(re.escape(part) for part in n.split("*")) for n in names)
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "name string, modified timestamp, n_bytes long, n_files long")
    # The path below the folder: its first part names the result.
    below = F.split_part(F.split("path", re.escape(f"/{inside}/"), 2)[1], F.lit("/"), F.lit(1))
    return (files.select(below.alias("name"), "modificationTime", "length").where(F.col("name").rlike(f"^(?:{wanted})$"))
            .groupBy("name").agg(F.max("modificationTime").alias("modified"), F.sum("length").alias("n_bytes"), F.count(F.lit(1)).alias("n_files")))


def latest_result_file(spark: SparkSession, folder: str, names: Sequence[str] = RESULT_NAMES,
                       schema: str = "title string, description string") -> DataFrame:
    """Rows of the newest result file of a folder, over all name patterns, with the columns which that file has (runs code
    different categories). Equal times: the last name. No such file: no rows, with ``schema``.

    One name comes to the driver; only that file is read then. The extension picks the reader: CSV, JSON, else Parquet."""
    newest = result_files(spark, folder, names).agg(F.max_by("name", F.struct("modified", "name")).alias("name")).first()["name"]
    if newest is None:
        return spark.createDataFrame([], schema)
    return read_by_extension(spark, f"{folder.rstrip('/')}/{newest}")
