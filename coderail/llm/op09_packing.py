"""Packing documents into sequences: first-fit decreasing with a tournament tree, in randomised groups.

A document's ids (with its end id) are cut into full pieces of ``seq_len`` and a rest.  Each group packs its pieces,
longest first, each into the first bin with room; a tournament tree over the bins' free room finds it in log time.
Groups are drawn by a seeded hash, hold about ``group_docs`` documents at any corpus size and share nothing, so the
work spreads over tasks; only (doc, length) rows are shuffled, never ids.

Null or empty text: one piece with the end id.  Null ``doc_id``: packed, dealt to groups by its place in the input; others
are dealt by id and text, so rows that share an id do not meet.
Repeated rows: each is packed.  Empty table: no rows.  Very long texts: many full pieces.  Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coderail.llm.common import exact_ids, mix64, slices, table
from coderail.llm.tokens import BATCH_BYTES, default_path, encoder

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = PIECE + ", sequence_id long, offset long"


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item, items taken longest first (equal lengths in given order)."""
    n = len(lengths)
    size = 1 << max(0, n - 1).bit_length()
    room = [capacity] * (2 * size)  # a node holds the largest room below it; bins are the leaves
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        need, node = int(lengths[i]), 1
        while node < size:
            node *= 2
            if room[node] < need:
                node += 1
        bins[i], offsets[i] = node - size, capacity - room[node]
        room[node] -= need
        while node > 1:
            node >>= 1
            left, right = room[2 * node], room[2 * node + 1]
            room[node] = left if left >= right else right
    return bins, offsets


def pieces(docs: DataFrame, tokenizer: str, end_id: int, seq_len: int, groups: int, seed: int,
           with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``seq_len`` ids of each document, with the group that will pack them."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        enc, end = encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        seen = TaskContext.get().partitionId() << 40
        for pdf in slices(frames, "text", BATCH_BYTES):
            encoded = enc.encode(list(pdf["text"]))
            ids = exact_ids(pdf["doc_id"])
            null = ids.isna().to_numpy()
            text = np.array([zlib.crc32(x) for x in encoded], np.uint64)  # rows that share an id are dealt by their texts
            with np.errstate(over="ignore"):
                key = mix64(ids.fillna(0).to_numpy(np.int64).astype(np.uint64) + (text << np.uint64(32)))
            key[null] = (seen + np.arange(len(pdf)))[null].astype(np.uint64)
            seen += len(pdf)
            with np.errstate(over="ignore"):
                group = mix64(key + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(groups)
            out = []
            for doc_id, missing, g, ids_raw in zip(ids, null, group.tolist(), encoded, strict=True):
                raw = ids_raw + end
                total = len(raw) // 4
                for s in range(0, total, seq_len):
                    part = raw[4 * s : 4 * min(s + seq_len, total)]
                    row = (None if missing else int(doc_id), s, len(part) // 4, zlib.crc32(part), total, g)
                    out.append((*row, part) if with_ids else row)
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "pack_group"] + ["ids"] * with_ids
            made = pd.DataFrame(out, columns=names)
            made["doc_id"] = exact_ids([r[0] for r in out])
            yield made

    schema = PIECE + ", pack_group long" + (", ids binary" if with_ids else "")
    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(cut, schema)


def pack(cut: DataFrame, seq_len: int) -> DataFrame:
    """Pieces with ``sequence_id`` (group and bin) and ``offset``; ``ids`` are carried along if they are there."""
    columns = [c for c in cut.columns if c != "pack_group"]

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(doc_id=exact_ids(pdf["doc_id"])).sort_values(["doc_id", "ids_crc32", "start"], kind="stable", na_position="first")
        bins, offsets = first_fit_decreasing(pdf["length"].to_numpy(), seq_len)
        return pdf[columns].assign(sequence_id=(int(key[0]) << 32) + bins, offset=offsets)

    schema = ", ".join(f"{n} {t}" for n, t in cut.drop("pack_group").dtypes) + ", sequence_id long, offset long"
    return cut.withColumn("doc_id", F.col("doc_id").cast("string")).groupBy("pack_group").applyInPandas(one, schema)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, seq_len: int = 4096, group_docs: int = 4096,
                   seed: int = 42, with_ids: bool = False) -> DataFrame:
    """All of ``docs`` in sequences of at most ``seq_len`` ids; one row per piece."""
    groups = max(1, -(-docs.count() // group_docs))
    return pack(pieces(docs, tokenizer, end_id, seq_len, groups, seed, with_ids), seq_len)


def sequences(packed: DataFrame, seq_len: int, pad_id: int) -> DataFrame:
    """The padded sequences themselves: sequence_id, n_tokens and ids (from pieces that carry ``ids``).  A sequence
    whose length is a power of two stays as it is."""

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        raw = b"".join(pdf.sort_values("offset")["ids"])
        n = len(raw) // 4
        pad = 0 if n & (n - 1) == 0 else seq_len - n
        return pd.DataFrame([(key[0], n, raw + np.full(pad, pad_id, "<u4").tobytes())])

    return packed.groupBy("sequence_id").applyInPandas(one, "sequence_id long, n_tokens long, ids binary")


def op9_ffd_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), default_path())
