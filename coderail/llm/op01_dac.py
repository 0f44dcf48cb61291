"""Token-ID output as directly addressable codes (DAC).

An id is cut into 8-bit chunks, lowest first.  Level 0 holds the first chunk of every id and a bitmap that says
which ids go on; level 1 holds the second chunk of just those, with a bitmap of its own, and so on.  A rank
directory (ones before every 512th bit) leads from a position of one level to that of the next, so any token is
read by a few look-ups and without decoding its block.

File format: Parquet without compression, one row per block of whole documents, in ascending order of ``doc_id``
(null first; equal ids by a hash of the text).  ``levels`` lists (chunks, bitmap, ranks) as little-endian binaries; ``doc_ids`` and
``doc_ends`` are the block's document directory.  ``first`` counts the ids before the block in its partition;
a partition's own offset follows from the counts of the partitions before it.

Null text: no ids but the end id.  Null ``doc_id``: kept, first.  Repeated rows: each is written.  Empty table: no
blocks, empty result.  Other columns are ignored.  Memory: a block of tokens (``block_tokens``) and its longest document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coderail.llm.common import parts_for, slices, table
from coderail.llm.tokens import BATCH_BYTES, default_path, encoder
from coderail.session import scratch_path

RANK_BITS = 512
BLOCK = ("part int, block int, first long, n_tokens long, doc_ids binary, doc_null binary, doc_ends binary, "
         "levels array<struct<chunks:binary,bitmap:binary,ranks:binary>>")


def dac_encode(ids: np.ndarray) -> list[dict]:
    """Levels of 8-bit chunks with continuation bitmaps and rank directories."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        step = RANK_BITS // 8
        ones = np.bitwise_count(np.pad(bits, (0, -len(bits) % step))).reshape(-1, step).sum(1, dtype=np.uint64)
        ranks = np.concatenate([[0], np.cumsum(ones)]).astype("<u8")
        levels.append({"chunks": (rest & 0xFF).astype(np.uint8).tobytes(), "bitmap": bits.tobytes(),
                       "ranks": ranks.tobytes()})
        rest = rest[more] >> np.uint32(8)
        if not len(rest):
            return levels


def dac_decode(levels) -> np.ndarray:
    """All ids of a block, as uint32."""
    out = np.zeros(len(levels[0]["chunks"]), np.uint32)
    at = np.arange(len(out))
    for k, level in enumerate(levels):
        chunks = np.frombuffer(level["chunks"], np.uint8)
        out[at] |= chunks.astype(np.uint32) << np.uint32(8 * k)
        at = at[np.unpackbits(np.frombuffer(level["bitmap"], np.uint8), count=len(chunks), bitorder="little") > 0]
    return out


def dac_get(levels, i: int) -> int:
    """The id at position ``i`` by rank look-ups, without decoding what lies around it."""
    value = 0
    for k, level in enumerate(levels):
        value |= level["chunks"][i] << (8 * k)
        bitmap = level["bitmap"]
        if not bitmap[i >> 3] >> (i & 7) & 1:
            return value
        start = i // RANK_BITS
        rank = int.from_bytes(level["ranks"][8 * start : 8 * start + 8], "little")
        word = int.from_bytes(bitmap[start * RANK_BITS // 8 : (i >> 3) + 1], "little")
        i = rank + (word & ((1 << (i - start * RANK_BITS)) - 1)).bit_count()
    return value


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int, block_tokens: int = 1 << 20,
              partition_bytes: int = 32 << 20) -> None:
    """Encode ``docs`` (doc_id, text) and write the id files below ``path``."""
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    parts = parts_for(docs, F.octet_length("text"), partition_bytes)

    def blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, block, first, enc = TaskContext.get().partitionId(), 0, 0, encoder(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        raw, doc_ids, ends, total = [], [], [], 0

        def row() -> pd.DataFrame:
            ids = np.frombuffer(b"".join(raw), "<u4")
            null = np.array([x is None for x in doc_ids], np.uint8)
            return pd.DataFrame([{
                "part": part, "block": block, "first": first, "n_tokens": total,
                "doc_ids": np.array([0 if x is None else x for x in doc_ids], "<i8").tobytes(),
                "doc_null": null.tobytes(), "doc_ends": np.array(ends, "<i8").tobytes(), "levels": dac_encode(ids)}])

        for pdf in slices(frames, "text", BATCH_BYTES):
            keys = [None if x is None else int(x) for x in pdf["id"]]
            for key, ids in zip(keys, enc.encode(list(pdf["text"])), strict=True):
                raw.append(ids + end)
                total += len(ids) // 4 + 1
                doc_ids.append(key)
                ends.append(total)
                if total >= block_tokens:
                    yield row()
                    block, first = block + 1, first + total
                    raw, doc_ids, ends, total = [], [], [], 0
        if doc_ids:
            yield row()

    (docs.repartitionByRange(parts, "doc_id", "h").sortWithinPartitions("doc_id", "h")
     .select(F.col("doc_id").cast("string").alias("id"), "text").mapInPandas(blocks, BLOCK).write.option("compression", "none").parquet(path))


def _with_offsets(blocks: DataFrame) -> DataFrame:
    """Blocks with ``start``, the ids of all blocks before: one row per written partition is broadcast, its number
    bounded by the partitions of the write."""
    from pyspark.sql import Window

    counts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    return (blocks.join(F.broadcast(offsets), "part")
            .withColumn("start", F.col("before") + F.col("first")))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document from the files: doc_id, start, n_tokens, ids_crc32 and the ids themselves (uint32 binary)."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for b in pdf.itertuples():
                ids = dac_decode(b.levels).astype("<u4")
                ends = np.frombuffer(b.doc_ends, "<i8")
                starts = np.concatenate([[0], ends[:-1]])
                raw = memoryview(ids.tobytes())
                cut = [raw[4 * s : 4 * e] for s, e in zip(starts, ends, strict=True)]
                doc_id = pd.Series(np.frombuffer(b.doc_ids, "<i8"), dtype="Int64")
                doc_id[np.frombuffer(b.doc_null, np.uint8) > 0] = pd.NA
                yield pd.DataFrame({"doc_id": doc_id, "start": b.start + starts, "n_tokens": ends - starts,
                                    "ids_crc32": [zlib.crc32(x) for x in cut], "ids": [bytes(x) for x in cut]})

    blocks = _with_offsets(spark.read.schema(BLOCK).parquet(path))
    return (blocks.select("start", "doc_ids", "doc_null", "doc_ends", "levels")
            .mapInPandas(rows, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"))


def token_at(spark: SparkSession, path: str, position: int) -> int | None:
    """The id at a position of the whole file set: the block by its start, the id by rank look-ups."""
    blocks = _with_offsets(spark.read.schema(BLOCK).parquet(path))
    hit = (blocks.where((F.col("start") <= position) & (F.col("start") + F.col("n_tokens") > position))
           .select("start", "levels").first())
    return None if hit is None else dac_get(hit["levels"], position - hit["start"])


def op1_token_dac(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token_dac")
    write_ids(table(spark, sf_dir, "documents"), path, default_path(), end_id=1)
    return read_documents(spark, path).drop("ids")
