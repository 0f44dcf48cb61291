"""What the operators of this subpackage share: reading, materialising and Arrow batch helpers."""

from __future__ import annotations

import gc
import time
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coderail.session import scratch_path

#: Words of every word-based operator: runs of anything but the ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished, unreferenced steps (it acts on JVM garbage only; what the
    newest step held becomes garbage with the first pass)."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)


def text_bytes(col: str | Column = "text") -> Column:
    """UTF-8 bytes of a text; null counts as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")).cast("binary")


def parts_for(df: DataFrame, size: Column, bytes_each: int, least: int = 32) -> int:
    """How many partitions hold ``bytes_each`` of ``size`` each; at least ``least``, so that a small input spreads too."""
    total = df.agg(F.sum(size)).first()[0] or 0
    return max(least, -(-int(total) // bytes_each))


def exact_ids(column: Iterable) -> pd.Series:
    """Ids, kept by pandas as strings or Python integers, as longs (beside a null pandas would make doubles of longs)."""
    return pd.Series([None if x is None else int(x) for x in column], dtype="Int64", index=column.index if isinstance(column, pd.Series) else None)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or that with underscores behind it, so that no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads the bits of weak 64-bit hashes."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(frames: Iterator[pd.DataFrame], column: str, limit: int = 8 << 20) -> Iterator[pd.DataFrame]:
    """Cut Arrow batches further so that ``column`` (bytes or text) holds about ``limit`` bytes in each."""
    for pdf in frames:
        if not len(pdf):
            continue
        size = np.cumsum([len(x) if x is not None else 0 for x in pdf[column]])
        group = size // limit
        for at in np.split(np.arange(len(pdf)), np.flatnonzero(np.diff(group)) + 1):
            yield pdf.iloc[at]


def arrow_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches, without copying, so that ``column`` (bytes or text) holds about ``limit`` bytes in each."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(lengths, dtype=np.int64) // limit
        edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(lengths)]
        for a, b in zip(edges, edges[1:]):
            if a < b:
                yield batch.slice(a, b - a)


def with_text_column(docs: DataFrame, name: str, kind: str, of: Callable[[list[str | None]], pa.Array],
                     limit: int = 8 << 20) -> DataFrame:
    """``docs``, all columns untouched, with the column ``name`` that ``of`` makes of whole texts.

    Arrow batches pass through; ``of`` gets about ``limit`` bytes of texts at a time.
    """
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T._parse_datatype_string(kind))])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrow_slices(batches, "text", limit):
            made = of(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*part.columns, made], names=[*part.schema.names, name])

    return docs.mapInArrow(rows, schema)
