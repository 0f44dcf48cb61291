"""Exact top-k inner products by block-at-a-time pruning.

Vectors are sorted by id and packed into blocks, each with its forward index (the matrix) and the largest and smallest
weight of every term (component).  A shard is some blocks; it meets the queries group by group.  For every query
the shard's blocks are ordered by the sum of the terms' best contributions, and scored until that bound falls below the
k-th score found.  The shards' best are merged by a ranking per query.

Weights are floor(1024 * x).  Vectors that are null, empty of ids or hold null or non-finite components take no part.
Shorter vectors count as filled up with zeros.  Repeated ids: each row is a candidate, and a query of its own.  Ties:
smaller id first, then any order among equal rows.  Empty table: no rows.  Other columns are ignored.
Memory: one shard (``shard_blocks`` blocks) and one group of queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coderail.llm.common import materialise, table

SCALE = 1024
QUERY_STEP = 100
TOP = 10
BLOCK_ROWS = 256
SHARD_BLOCKS = 16
QUERY_GROUP = 4096


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id and integer weights of the rows that take part, numbered by ``rid`` in the order of ids."""
    x = F.col("embedding")
    finite = ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    w = F.transform(x, lambda v: F.floor(F.lit(SCALE) * v.cast("double")))
    return vectors.where(x.isNotNull() & F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False))).select("vec_id", w.alias("w"))


BLOCK = "shard long, rids binary, ids binary, dims int, weights binary"


def blocks(vectors: DataFrame, parts: int, block_rows: int, shard_blocks: int) -> DataFrame:
    """Blocks of vectors in ascending id; ``shard`` numbers runs of them."""
    rows = vectors.repartitionByRange(parts, "vec_id").sortWithinPartitions("vec_id").withColumn("rid", F.monotonically_increasing_id())

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        first, n = TaskContext.get().partitionId() << 32, 0
        for pdf in frames:
            for at in range(0, len(pdf), block_rows):
                part = pdf.iloc[at : at + block_rows]
                dims = max(map(len, part["w"]), default=0)
                matrix = np.zeros((len(part), dims), "<i8")
                for r, w in enumerate(part["w"]):
                    matrix[r, : len(w)] = w
                yield pd.DataFrame([(first + n // shard_blocks, part["rid"].to_numpy("<i8").tobytes(),
                                     part["vec_id"].to_numpy("<i8").tobytes(), dims, matrix.tobytes())],
                                   columns=["shard", "rids", "ids", "dims", "weights"])
                n += 1

    return rows.mapInPandas(pack, BLOCK)


def _matrix(row, dims: int) -> np.ndarray:
    own = np.frombuffer(row.weights, "<i8").reshape(len(row.ids) // 8, row.dims)
    return np.pad(own, ((0, 0), (0, dims - row.dims)))


def best_in_shard(forward: list[np.ndarray], ids: list[np.ndarray], rids: list[np.ndarray], queries: np.ndarray,
                  query_rids: np.ndarray, k: int) -> tuple[list[tuple], int]:
    """(query's place, id, score) of each query's ``k`` best in these blocks, and the blocks scored."""
    most = np.stack([m.max(0) for m in forward])
    least = np.stack([m.min(0) for m in forward])
    bound = np.maximum(queries, 0) @ most.T + np.minimum(queries, 0) @ least.T
    order = np.argsort(-bound, axis=1, kind="stable")
    out, scored = [], 0
    for q, query in enumerate(queries):
        best_score, best_id = np.zeros(0, queries.dtype), np.zeros(0, np.int64)
        for b in order[q].tolist():
            if len(best_score) == k and bound[q, b] < best_score[-1]:
                break
            scored += 1
            score = forward[b] @ query
            other = rids[b] != query_rids[q]
            score, vec = np.concatenate([best_score, score[other]]), np.concatenate([best_id, ids[b][other]])
            if len(score) > 4 * k:  # all that may still be among the best, ties included
                near = score >= np.partition(score, len(score) - k)[len(score) - k]
                score, vec = score[near], vec[near]
            top = np.lexsort((vec, -score))[:k]
            best_score, best_id = score[top], vec[top]
        out += [(q, v, s) for v, s in zip(best_id.tolist(), best_score.tolist(), strict=True)]
    return out, scored


def top_k(vectors: DataFrame, k: int = TOP, step: int = QUERY_STEP, block_rows: int = BLOCK_ROWS,
          shard_blocks: int = SHARD_BLOCKS, query_group: int = QUERY_GROUP) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best of every row whose id is divisible by ``step``."""
    vectors = valid_vectors(vectors)
    parts = max(int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    packed = materialise(blocks(vectors, parts, block_rows, shard_blocks), "vector_blocks")

    def own_queries(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for row in pdf.itertuples():
                ids = np.frombuffer(row.ids, "<i8")
                hit = np.flatnonzero(ids % step == 0)
                matrix = _matrix(row, row.dims)
                yield pd.DataFrame({"rid": np.frombuffer(row.rids, "<i8")[hit], "query_id": ids[hit], "w": [matrix[i].tobytes() for i in hit]})

    queries = materialise(packed.mapInPandas(own_queries, "rid long, query_id long, w binary"), "queries")
    groups = max(1, -(-queries.count() // query_group))
    queries = queries.withColumn("q", F.pmod(F.xxhash64("rid"), F.lit(groups)))
    every_group = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))
    # a stated query set against all rows, in blocks: (shard, group of queries) is the unit of work
    left = packed.withColumn("q", every_group)
    shards = packed.select(F.col("shard").alias("s")).distinct()
    right = queries.join(shards.withColumn("q", every_group), "q")

    def meet(b: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        names = ["rid", "query_id", "vec_id", "score"]
        if not len(b) or not len(q):
            return pd.DataFrame([], columns=names)
        dims = max(int(b["dims"].max()), max(len(w) // 8 for w in q["w"]))
        forward = [_matrix(row, dims) for row in b.itertuples()]
        asked = np.zeros((len(q), dims), np.int64)
        for i, w in enumerate(q["w"]):
            asked[i, : len(w) // 8] = np.frombuffer(w, "<i8")
        largest = max(float(np.abs(m).max(initial=0)) for m in forward) * float(np.abs(asked).max(initial=0)) * max(1, dims)
        if largest < 2**53:  # products and sums are exact in doubles, which multiply faster
            forward, asked = [m.astype(float) for m in forward], asked.astype(float)
        ids = [np.frombuffer(x, "<i8") for x in b["ids"]]
        rids = [np.frombuffer(x, "<i8") for x in b["rids"]]
        got, _ = best_in_shard(forward, ids, rids, asked, q["rid"].to_numpy(), k)
        at = [g[0] for g in got]
        return pd.DataFrame({"rid": q["rid"].to_numpy()[at], "query_id": q["query_id"].to_numpy()[at],
                             "vec_id": [g[1] for g in got], "score": [int(g[2]) for g in got]}, columns=names)

    found = left.groupBy("shard", "q").cogroup(right.groupBy("s", "q")).applyInPandas(meet, "rid long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("rid").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_block_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


OP8_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS w
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.w, c.w) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
