"""Entry (text) tables: CSV / Parquet readers with an explicit schema and an input-order column."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..operators.prep import require_columns

NULL_MARKER = "\u0000<null>\u0000"


class EmptyDataError(ValueError):
    pass


def _fmt(path: str, fmt: str | None) -> str:
    if fmt:
        return fmt
    p = path.rstrip("/").lower()
    if p.endswith(".xlsx"):
        return "xlsx"
    if p.endswith(".parquet"):
        return "parquet"
    if p.endswith(".json"):
        return "json"
    return "csv"


def _is_empty_file(spark: SparkSession, path: str) -> bool:
    """A single zero-byte file, checked through the Hadoop file system of the path (local, HDFS,
    object stores alike); folders and globs are left to the reader."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    try:
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        st = fs.getFileStatus(p)
    except Exception:  # noqa: BLE001 - globs and odd paths: let the reader decide
        return False
    return st.isFile() and st.getLen() == 0


def _csv_reader(spark: SparkSession):
    rd = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    rd = rd.option("mode", "FAILFAST").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    # An unquoted empty field is NULL, a quoted one ("") the empty string: with the default
    # nullValue "" both would read as NULL.
    return rd.option("nullValue", NULL_MARKER).option("emptyValue", "")


def _by_header(spark: SparkSession, path: str) -> list[list[str]]:
    """The files below a path, grouped by their first line (one group where all agree)."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
                                         F.monotonically_increasing_id().alias("row")).where("at = 0")
    first = lines.groupBy("file").agg(F.min_by("value", "row").alias("header"))
    groups: dict[str, list[str]] = {}
    for r in first.orderBy("file").collect():  # a row per file, as the driver lists them anyway
        groups.setdefault(r["header"], []).append(unquote(r["file"]))
    return list(groups.values())


def _read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV files below a path by the header that each one has. The reader takes one header for all files it is given, so
    files are read per header and put together by column names; columns that a file lacks are NULL."""
    df = _csv_reader(spark).csv(path)
    if len(df.inputFiles()) < 2:
        return df
    groups = _by_header(spark, path)
    if len(groups) < 2:
        return df
    # The header that counts is checked in every file: one that goes on behind its first line is refused, not mixed up.
    parts = [_csv_reader(spark).option("enforceSchema", False).csv(files) for files in groups]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _read(spark: SparkSession, path: str, kind: str) -> DataFrame:
    if kind == "xlsx":
        raise ValueError(f"Error loading data file: no Spark reader for xlsx ({path}); export to CSV or Parquet")
    if kind == "csv":
        return _read_csv(spark, path)
    return spark.read.json(path) if kind == "json" else spark.read.parquet(path)


def read_by_extension(spark: SparkSession, path: str) -> DataFrame:
    """Any table by its extension: CSV by its header, JSON lines, else Parquet."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return _read(spark, path, _fmt(path, None if "." in name else "parquet"))


def load_entries(spark: SparkSession, path: str, fmt: str | None = None, ordinal_col: str | None = "ordinal") -> DataFrame:
    """Reads an entry table. The extension picks the reader (CSV unless told otherwise).

    CSV is read by its header: ``title`` and ``description`` are required, in any order and next to
    any other columns, which are kept as text (types are never inferred); in a folder every file goes by
    its own header. RFC-4180 quoting and
    multi-line fields; a multi-line file is read by one task, so prefer Parquet for large input.
    ``ordinal`` is the input order. A source without that column gets ``monotonically_increasing_id``
    (increasing in file order for one file), as with ``ordinal_col=None``. Distinct errors for a
    missing file, an empty file, missing columns and other failures.
    """
    kind = _fmt(path, fmt)
    try:
        df = _read(spark, path, kind)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise FileNotFoundError(f"Data file not found: {path}") from e
        raise ValueError(f"Error loading data file: {e}") from e
    if kind == "csv" and _is_empty_file(spark, path):
        raise EmptyDataError(f"Data file is empty: {path}")
    require_columns(df, ["title", "description"])
    df = df.withColumns({c: F.col(c).cast("string") for c in ("title", "description")})
    if ordinal_col is None or ordinal_col not in df.columns:
        return df.withColumn("ordinal", F.monotonically_increasing_id())
    return df.withColumn("ordinal", F.col(ordinal_col).cast("bigint"))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Prepared texts / codes as CSV with a header; quotes doubled, blanks kept (Spark's writer would
    otherwise trim leading and trailing blanks of every value). NULL is an unquoted empty field and
    the empty string is written as "" so that both survive a round trip."""
    (df.write.mode(mode).option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))
