"""Approximate nearest neighbours by cosine: a hierarchical k-means tree, searched best bin first.

The tree is fitted on at most ``SAMPLE`` vectors, drawn by a hash: every node is cut into ``BRANCH`` clusters by spherical
k-means until ``LEAF_SAMPLE`` sample vectors are left.  Every vector of the table is then led down to its leaf.  A query runs
down to its own leaf, leaves the branches it passes in a priority queue by nearness of their centres, and goes on with
the best of them, leaf after leaf.  How many leaves it visits is calibrated: exact neighbours of at most
``CALIBRATION`` queries are found by brute force, and the visits widen until ``TARGET_RECALL`` of them lie in visited leaves
(all leaves, at the worst, which is exact).

Subtrees of at most ``CELL_ROWS`` vectors are cells; a leaf above that is dealt over several shards by a hash.  Queries meet
(cell, shard) in chunks, and only the leaves they chose are scored.  Equal vectors are one entry of the index with the
``k + 1`` smallest ids, which are all that a result can need, so copies cost nothing.

Vectors that are null, empty, zero or hold null or non-finite components, and rows without ``vec_id``, take no part.  Shorter
vectors count as filled up with zeros.  Repeated ids: each row is a candidate, and a query of its own.  Ties: smaller id.
Empty table: no rows.  Other columns are ignored.  Memory: one (cell, shard) with a chunk of queries; the sample
in one task; the tree (at most ``SAMPLE`` leaves) in every task.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coderail.llm.common import materialise, table

QUERY_STEP, TOP = 50, 5
SAMPLE, BRANCH, LEAF_SAMPLE, ROUNDS = 32_768, 8, 32, 8
CALIBRATION, TARGET_RECALL = 1024, 0.99
CELL_ROWS, QUERY_CHUNK = 8192, 512
#: Queries that one task leads through the tree.
QUERIES_EACH = 128
#: Scores of matrix products this close to a limit are computed again, one by one.
NEAR = 1e-9


class Tree(NamedTuple):
    """Nodes by number, the children of one side by side: centres, first child, number of children (0: a leaf)."""

    centres: np.ndarray
    first: np.ndarray
    children: np.ndarray


def matrix(vectors, dims: int) -> np.ndarray:
    """Rows of little-endian doubles, filled up with zeros."""
    out = np.zeros((len(vectors), dims))
    for i, x in enumerate(vectors):
        own = np.frombuffer(x, "<f8")[:dims]
        out[i, : len(own)] = own
    return out


def units(x: np.ndarray) -> np.ndarray:
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True, initial=0), 1e-300)
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-300)


def clusters(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray | None:
    """Cluster of each unit vector by spherical k-means; None where they do not come apart."""
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(ROUNDS):
        at = np.argmax(x @ centres.T, axis=1)
        used = np.unique(at)
        if len(used) < 2:
            return None
        centres = units(np.stack([x[at == c].sum(axis=0) for c in used]))
    return np.argmax(x @ centres.T, axis=1)


def fit(x: np.ndarray, branch: int = BRANCH, leaf_rows: int = LEAF_SAMPLE, seed: int = 42) -> Tree:
    """The tree of unit vectors."""
    rng = np.random.default_rng(seed)
    centres, first, children, rows = [np.zeros(x.shape[1])], [0], [0], [np.arange(len(x))]
    node = 0
    while node < len(rows):
        own = rows[node]
        at = clusters(x[own], branch, rng) if len(own) > leaf_rows else None
        used = [] if at is None else np.unique(at).tolist()
        if len(used) > 1:
            first[node], children[node] = len(rows), len(used)
            for c in used:
                part = own[at == c]
                rows.append(part)
                centres.append(units(x[part].sum(axis=0, keepdims=True))[0])
                first.append(0)
                children.append(0)
        node += 1
    return Tree(np.stack(centres), np.array(first), np.array(children))


def leaves_of(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The leaf (a node's number) that each unit vector runs down to."""
    at, going = np.zeros(len(x), np.int64), [(0, np.arange(len(x)))]
    while going:
        node, rows = going.pop()
        at[rows] = node
        if tree.children[node] and len(rows):
            a, b = tree.first[node], tree.first[node] + tree.children[node]
            best = np.argmax(x[rows] @ tree.centres[a:b].T, axis=1)
            going += [(a + c, rows[best == c]) for c in np.unique(best).tolist()]
    return at


def best_bins(tree: Tree, x: np.ndarray, most: int) -> Iterator[list[int]]:
    """For each unit vector the leaves it visits, in order: down to a leaf, then on from the best branch left out."""
    first, children = tree.first.tolist(), tree.children.tolist()
    for begin in range(0, len(x), 256):
        for near in (x[begin : begin + 256] @ tree.centres.T).tolist():
            queue, out = [(0.0, 0)], []
            while queue and len(out) < most:
                _, node = heapq.heappop(queue)
                while children[node]:
                    branches = sorted((-near[c], c) for c in range(first[node], first[node] + children[node]))
                    node = branches[0][1]
                    for b in branches[1:]:
                        heapq.heappush(queue, b)
                out.append(node)
            yield out


def widened(ranks: np.ndarray, leaves: int, target: float) -> int:
    """Leaves to visit so that ``target`` of the neighbours, at these places of the visits, are reached."""
    visits = 1
    while visits < leaves and (ranks < visits).mean() < target:
        visits = min(leaves, max(visits + 1, visits * 5 // 4))
    return visits


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``x`` with ``y``, sums in the order of the components."""
    def total(v):
        return np.cumsum(v, axis=-1)[..., -1]

    xx, yy = total(x * x), total(y * y)
    both = xx * yy
    with np.errstate(invalid="ignore", over="ignore"):
        length = np.where((both > 1e-290) & (both < np.inf), np.sqrt(both), np.sqrt(xx) * np.sqrt(yy))
    return total(x * y) / length


def best_of(x: np.ndarray, scores: np.ndarray, ids: list, raw: list, query: np.ndarray, query_raw: bytes, k: int) -> list[tuple]:
    """(score, id, same vector) of the ``k`` nearest among those scored, from the matrix product ``scores`` (-inf: not visited)."""
    seen = np.flatnonzero(scores > -np.inf)
    if len(seen) > k:
        least = np.partition(scores[seen], len(seen) - k)[len(seen) - k]
        seen = seen[scores[seen] >= least - NEAR]
    exact = cosines(x[seen], query)
    found = [(-s, i, raw[at] == query_raw) for at, s in zip(seen.tolist(), exact.tolist(), strict=True) for i in ids[at]]
    return [(-s, i, same) for s, i, same in sorted(found)[:k]]


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id and x (little-endian doubles) of the rows that take part."""
    e = F.col("embedding")
    bad = F.exists(e, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    some = F.exists(e, lambda v: v != 0)
    rows = vectors.where(F.col("vec_id").isNotNull() & ~F.coalesce(bad, F.lit(True)) & some)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("e")
            ends, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype("<f8") + 0.0
            raw = [values[a:b].tobytes() for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(raw, pa.binary())], names=["vec_id", "x"])

    return rows.select("vec_id", e.cast("array<double>").alias("e")).mapInArrow(pack, "vec_id long, x binary")


def entries(rows: DataFrame, k: int) -> DataFrame:
    """One row per distinct vector: x, its ``k`` smallest ids and cid, a hash that draws samples and shards."""
    few = rows.withColumn("r", F.row_number().over(Window.partitionBy("x").orderBy("vec_id"))).where(F.col("r") <= k)
    return few.groupBy("x").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).withColumn("cid", F.xxhash64("x"))


def name_of(x: str):
    """A vector's own name, of 32 bytes."""
    return F.unhex(F.sha2(F.col(x), 256))


class Index:
    """A fitted tree over written entries: ``rows`` (cid, x, ids, leaf), vectors per leaf, cells and their shards."""

    def __init__(self, vectors: DataFrame, keep: int, sample: int, leaf_rows: int, cell_rows: int):
        own = materialise(entries(vectors, keep), "vector_entries")
        got = own.select("x").orderBy(F.xxhash64("cid"), "x").limit(sample).repartition(1).mapInPandas(
            _fit_task(leaf_rows), "dims int, centres binary, first binary, children binary").first()
        self.tree = None
        if got is None:
            return
        dims = got["dims"]
        self.dims = dims
        self.tree = tree = Tree(np.frombuffer(got["centres"], "<f8").reshape(-1, dims), np.frombuffer(got["first"], "<i8"), np.frombuffer(got["children"], "<i8"))

        def led(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = units(matrix(batch.column("x").to_pylist(), dims))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaves_of(tree, x).astype("<i4"))], names=[*batch.schema.names, "leaf"])

        # longer vectors than the sample's longest are led by their first components, and scored whole
        self.rows = materialise(own.mapInArrow(led, "x binary, ids array<long>, cid long, leaf int"), "vector_leaves")
        self.longest = self.rows.agg(F.max(F.octet_length("x"))).first()[0] // 8
        counts = {r["leaf"]: r["count"] for r in self.rows.groupBy("leaf").count().collect()}  # a row per leaf of the tree
        size = np.array([counts.get(n, 0) for n in range(len(tree.first))])
        for node in range(len(size) - 1, -1, -1):  # children have higher numbers
            size[node] += size[tree.first[node] : tree.first[node] + tree.children[node]].sum()
        self.leaves = int((tree.children == 0).sum())
        self.cell = np.zeros(len(size), np.int64)
        self.shards = {}
        going = [(0, None)]
        while going:
            node, cell = going.pop()
            if cell is None and (size[node] <= cell_rows or not tree.children[node]):
                cell = node
                self.shards[cell] = max(1, -(-int(size[node]) // cell_rows))
            self.cell[node] = -1 if cell is None else cell
            going += [(tree.first[node] + c, cell) for c in range(tree.children[node])]


def _fit_task(leaf_rows: int):
    def one(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        raw = [x for pdf in frames for x in pdf["x"]]
        if raw:
            dims = max(len(x) for x in raw) // 8
            tree = fit(units(matrix(raw, dims)), leaf_rows=leaf_rows)
            yield pd.DataFrame([(dims, tree.centres.astype("<f8").tobytes(), tree.first.astype("<i8").tobytes(), tree.children.astype("<i8").tobytes())],
                               columns=["dims", "centres", "first", "children"])

    return one


def calibrated(index: Index, queries: DataFrame, keep: int, sample: int, target: float) -> int:
    """Leaves to visit, from the exact neighbours, other than equal vectors, of at most ``sample`` of the queries (qid, x)."""
    tree, dims, longest, leaves_in_all = index.tree, index.dims, index.longest, index.leaves
    drawn = queries.select("qid", "x").orderBy(F.xxhash64("qid", F.lit(1)), "qid").limit(sample).collect()
    asked, numbers, raw = matrix([r["x"] for r in drawn], longest), [bytes(r["qid"]) for r in drawn], [bytes(r["x"]) for r in drawn]

    def exact(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = [[] for _ in numbers]
        for pdf in frames:
            x = matrix(list(pdf["x"]), longest)
            scores = units(x) @ units(asked).T
            ids, own, leaf = list(pdf["ids"]), list(pdf["x"]), pdf["leaf"].tolist()
            leaf_of = {int(i): f for group, f in zip(ids, leaf, strict=True) for i in group}
            for q in range(len(numbers)):
                found = [(-s, i, same, leaf_of[i]) for s, i, same in best_of(x, scores[:, q], ids, own, asked[q], raw[q], keep)]
                best[q] = sorted(best[q] + found)[:keep]
        yield pd.DataFrame([(numbers[q], -s, i, f) for q, own in enumerate(best) for s, i, same, f in own if not same], columns=["qid", "score", "vec_id", "leaf"])

    true = index.rows.select("x", "ids", "leaf").mapInPandas(exact, "qid binary, score double, vec_id long, leaf int")
    rank = F.row_number().over(Window.partitionBy("qid").orderBy(F.col("score").desc(), "vec_id"))
    true = true.withColumn("r", rank).where(F.col("r") < keep).groupBy("qid").agg(F.collect_list("leaf").alias("leaves")).repartition(-(-sample // QUERIES_EACH))

    def places(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = {n: i for i, n in enumerate(numbers)}
        for pdf in frames:
            x = units(asked[[at[bytes(n)] for n in pdf["qid"]], :dims])
            out = []
            for leaves, visits in zip(pdf["leaves"], best_bins(tree, x, leaves_in_all), strict=True):
                order = {leaf: i for i, leaf in enumerate(visits)}
                out += [order[f] for f in leaves]
            yield pd.DataFrame({"place": out})

    ranks = np.array([r["place"] for r in true.mapInPandas(places, "place long").collect()])  # at most sample * keep numbers
    return widened(ranks, leaves_in_all, target) if len(ranks) else 1


FOUND = "qid binary, score double, vec_id long, same boolean"


def nearest(vectors: DataFrame, k: int = TOP, step: int = QUERY_STEP, sample: int = SAMPLE, leaf_rows: int = LEAF_SAMPLE,
            cell_rows: int = CELL_ROWS, query_chunk: int = QUERY_CHUNK, calibration: int = CALIBRATION,
            target: float = TARGET_RECALL) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest found of every row whose id is divisible by ``step``."""
    spark = vectors.sparkSession
    rows = materialise(valid_vectors(vectors), "valid_vectors")
    keep = k + 1  # one may be the query's own row
    index = Index(rows, keep, sample, leaf_rows, cell_rows)
    if index.tree is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    asked = rows.where(F.col("vec_id") % step == 0)
    queries = materialise(asked.select("x").distinct().withColumn("qid", name_of("x")), "vector_queries")
    visits = calibrated(index, queries, keep, calibration, target)
    tree, dims, longest, cell_of = index.tree, index.dims, index.longest, index.cell

    def chosen(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for qid, x, leaves in zip(pdf["qid"], pdf["x"], best_bins(tree, units(matrix(list(pdf["x"]), dims)), visits), strict=True):
                by = {}
                for leaf in leaves:
                    by.setdefault(int(cell_of[leaf]), []).append(leaf)
                out += [(qid, x, cell, np.array(own, "<i4").tobytes()) for cell, own in by.items()]
            yield pd.DataFrame(out, columns=["qid", "x", "cell", "leaves"])

    spread = queries.select("qid", "x").repartition(max(1, -(-queries.count() // QUERIES_EACH)))  # few bytes, much work
    wanted = materialise(spread.mapInPandas(chosen, "qid binary, x binary, cell long, leaves binary"), "vector_visits")
    asking = {r["cell"]: r["count"] for r in wanted.groupBy("cell").count().collect()}  # a row per cell of the tree
    plan = [(int(c), index.shards[c], max(1, -(-n // query_chunk))) for c, n in asking.items()]
    plan = F.broadcast(spark.createDataFrame(plan, "cell long, shards int, chunks int"))  # at most SAMPLE cells

    def with_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell_of[batch.column("leaf").to_numpy()])], names=[*batch.schema.names, "cell"])

    def up_to(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    left = (index.rows.mapInArrow(with_cell, "x binary, ids array<long>, cid long, leaf int, cell long").join(plan, "cell")
            .withColumn("shard", F.pmod(F.xxhash64("cid"), F.col("shards")).cast("int")).withColumn("chunk", up_to("chunks")).drop("shards", "chunks"))
    right = (wanted.join(plan, "cell").withColumn("chunk", F.pmod(F.xxhash64("qid"), F.col("chunks")).cast("int"))
             .withColumn("shard", up_to("shards")).drop("shards", "chunks"))

    def meet(b: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        names = [c.split()[0] for c in FOUND.split(", ")]
        if not len(b) or not len(q):
            return pd.DataFrame([], columns=names)
        x, asking = matrix(list(b["x"]), longest), matrix(list(q["x"]), longest)
        ux, uq = units(x), units(asking)
        leaf, scores = b["leaf"].to_numpy(), np.full((len(q), len(b)), -np.inf)
        visited = [np.frombuffer(v, "<i4") for v in q["leaves"]]
        for f in np.unique(leaf).tolist():
            own, who = np.flatnonzero(leaf == f), np.flatnonzero([f in v for v in visited])
            if len(who):
                scores[np.ix_(who, own)] = uq[who] @ ux[own].T
        ids, raw = list(b["ids"]), list(b["x"])
        out = [(qid, s, i, same) for n, (qid, own) in enumerate(zip(q["qid"], q["x"], strict=True))
               for s, i, same in best_of(x, scores[n], ids, raw, asking[n], own, keep)]
        return pd.DataFrame(out, columns=names)

    found = left.groupBy("cell", "shard", "chunk").cogroup(right.groupBy("cell", "shard", "chunk")).applyInPandas(meet, FOUND)
    rank = F.row_number().over(Window.partitionBy("qid").orderBy(F.col("score").desc(), "vec_id"))
    best = found.withColumn("r", rank).where(F.col("r") <= keep).groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("r", "vec_id", "score", "same"))).alias("best"))
    # each query row leaves out its own entry: the first with its id and its very vector
    mine = F.array_position(F.transform("best", lambda b: b.same & (b.vec_id == F.col("query_id"))), True)
    others = F.slice(F.filter("best", lambda b, i: i + 1 != mine), 1, k)
    per_row = asked.select(F.col("vec_id").alias("query_id"), name_of("x").alias("qid")).join(best, "qid")
    return per_row.select("query_id", F.posexplode(others).alias("at", "b")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), F.col("b.score").alias("score"))


def op11_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


#: Exact neighbours.  The query finds just these wherever all its queries serve as calibration and 0.99 of their neighbours
#: is all of them, as in tables of under 1,000 vectors.
OP11_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
