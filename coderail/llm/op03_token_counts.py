"""Token counts by SentencePiece, with overlap resynchronisation for huge documents.

A document longer than ``chunk_chars`` is cut into overlapping chunks that are encoded in different tasks, with the
offsets of their pieces; each chunk counts the pieces between its two splice points.  A splice point must be proven
stable: it lies before a blank that follows another character, and no piece of the vocabulary holds its blank mark
behind another character, so no merge ever crosses it, whatever stands left and right.  Both neighbours must show a
piece boundary there.  Where an overlap holds no such point it is widened twofold until one is found or the chunk
joins its neighbour.  A vocabulary that breaks the proof turns splicing off: then every document is encoded whole.

Null text: 0 bytes, 0 tokens.  Null ``doc_id`` and repeated rows: one result each.  Empty table: no rows.  Other
columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coderail.llm.common import exact_ids, slices, table

LIMIT = 4096
MARK = "▁"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@functools.cache
def processor(path: str):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path)


@functools.cache
def spliceable(path: str) -> bool:
    """No piece has a blank mark behind another character, and blanks are kept as they are."""
    sp = processor(path)
    inner = any(MARK in sp.id_to_piece(i).lstrip(MARK) for i in range(sp.get_piece_size()))
    return not inner and sp.encode(" a  b ", out_type=str) != sp.encode("a b", out_type=str)


def stable(text: str, at: int) -> bool:
    return 0 < at < len(text) and text[at] == " " and text[at - 1] not in (" ", MARK)


def splice_points(text: str, chunk: int, overlap: int) -> list[int]:
    """Stable points near every multiple of ``chunk``; the search widens twofold from ``overlap`` to a whole chunk."""
    points = []
    for middle in range(chunk, len(text), chunk):
        width = overlap
        while True:
            width = min(width, chunk)
            lo = max(middle - width, points[-1] + 1 if points else 1)
            at = next((i for i in range(lo, min(middle + width, len(text))) if stable(text, i)), None)
            if at is not None or width == chunk:
                break
            width *= 2
        if at is not None:
            points.append(at)
    return points


def cut(text: str, chunk: int, overlap: int) -> list[tuple[str, int, int]]:
    """Chunks with their overlaps, and where the counted part of each begins and ends."""
    edges = [0, *splice_points(text, chunk, overlap), len(text)]
    out = []
    for a, b in zip(edges, edges[1:]):
        lo, hi = max(0, a - overlap), min(len(text), b + overlap)
        out.append((text[lo:hi], a - lo, b - lo))
    return out


def count_between(sp, text: str, start: int, end: int) -> int:
    """Pieces of ``text`` that begin in [start, end); both must be piece boundaries of this encoding."""
    first, last, size = (len(x.encode()) for x in (text[:start], text[:end], text))  # offsets are in bytes
    begins = [p.begin for p in sp.encode(text, return_type="proto").pieces]
    seen = set(begins)
    if any(0 < at < size and at not in seen for at in (first, last)):
        raise AssertionError("a proven splice point is no piece boundary: the vocabulary breaks the proof")
    return sum(first <= b and (b < last or last == size) for b in begins)


def count_tokens(docs: DataFrame, model: str, limit: int = LIMIT, chunk_chars: int = 1 << 15, overlap: int = 256) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of each document."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), size.alias("n_bytes"), F.coalesce("text", F.lit("")).alias("text"))
    split = spliceable(model)
    huge = F.length("text") > chunk_chars if split else F.lit(False)

    def whole(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sp = processor(model)
        for pdf in slices(frames, "text"):
            yield pdf[["n_bytes"]].assign(doc_id=exact_ids(pdf["doc_id"]), n_tokens=[len(x) for x in sp.encode(list(pdf["text"]), num_threads=1)])

    def chunks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 40
        for pdf in frames:
            for doc_id, n_bytes, text in zip(pdf["doc_id"], pdf["n_bytes"], pdf["text"], strict=True):
                row += 1
                made = pd.DataFrame(cut(text, chunk_chars, overlap), columns=["text", "lo", "hi"])
                made.insert(0, "n_bytes", n_bytes)
                made.insert(0, "doc_id", doc_id)
                yield made.assign(row=row, chunk=range(len(made)))

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sp = processor(model)
        for pdf in frames:
            n = [count_between(sp, t, a, b) for t, a, b in zip(pdf["text"], pdf["lo"], pdf["hi"], strict=True)]
            yield pdf[["row", "n_bytes"]].assign(doc_id=exact_ids(pdf["doc_id"]), n_tokens=n)

    result = "doc_id long, n_bytes long, n_tokens long"
    small = rows.where(~huge).mapInPandas(whole, result)
    dealt = (rows.where(huge).mapInPandas(chunks, "doc_id string, n_bytes long, text string, lo int, hi int, row long, chunk int")
             .repartition("row", "chunk"))  # the chunks of one document go to different tasks
    spliced = (dealt.mapInPandas(counted, "row long, " + result)
               .groupBy("row", "doc_id", "n_bytes").agg(F.sum("n_tokens").alias("n_tokens")).drop("row"))
    return small.unionByName(spliced).withColumn("over_limit", F.col("n_tokens") > limit)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), default_path())
