import math
import random

import numpy as np

from coderail.llm.op08_topk import best_in_shard, op8_block_topk, top_k

SCHEMA = "vec_id long, embedding array<float>, label int, score long, rank int"


def rows_of(seed=1, n=260):
    rng = random.Random(seed)
    rows = [(i, [np.float32(rng.gauss(0, 0.2)).item() for _ in range(16)], 0, 1, 2) for i in range(n)]
    rows += [(i + 1000, rows[7][1], 0, 1, 2) for i in range(40)]  # ties
    rows += [(300, rows[3][1], 0, 1, 2), (300, rows[3][1], 0, 1, 2), (400, rows[9][1][:5], 0, 1, 2), (500, [], 0, 1, 2)]
    rows += [(600, None, 0, 1, 2), (700, [1.0, None], 0, 1, 2), (800, [float("nan")] * 16, 0, 1, 2), (None, rows[1][1], 0, 1, 2), (900, [float("inf")], 0, 1, 2)]
    return rows


def brute(rows, k=10, step=100):
    ok = [(i, [math.floor(1024 * x) for x in e]) for i, e, *_ in rows if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for a, (q, u) in enumerate(ok):
        if q % step == 0:
            scores = sorted((-sum(x * y for x, y in zip(u, v)), c) for b, (c, v) in enumerate(ok) if a != b)[:k]
            out += [(q, r, c, -s) for r, (s, c) in enumerate(scores, 1)]
    return sorted(out)


def test_query_equals_brute_force(spark, tmp_path):
    for rows in (rows_of(), rows_of(2, 12)[:6]):
        spark.createDataFrame(rows, SCHEMA).repartition(3).write.mode("overwrite").parquet(f"{tmp_path}/embeddings.parquet")
        assert sorted(tuple(r) for r in op8_block_topk(spark, str(tmp_path)).collect()) == brute(rows)


def test_small_blocks_and_groups(spark):
    rows = rows_of(3)
    got = top_k(spark.createDataFrame(rows, SCHEMA), 4, 10, block_rows=8, shard_blocks=3, query_group=5)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 4, 10)


def test_blocks_below_the_kth_score_are_left_out():
    rng = np.random.default_rng(1)
    forward = [rng.normal(0, 1, (20, 8)) + (30 if b == 5 else 0) for b in range(10)]
    ids = [np.arange(20) + 20 * b for b in range(10)]
    got, scored = best_in_shard(forward, ids, ids, np.ones((1, 8)), np.array([-1]), 10)
    assert scored == 1 and len(got) == 10 and all(100 <= v < 120 for _, v, _ in got)


def test_large_weights_stay_exact(spark):
    rows = [(i * 100, [1e5 + i, -1e5, 3.0 * i], 0, 0, 0) for i in range(5)]
    rows = [(i, [np.float32(x).item() for x in e], *z) for i, e, *z in rows]
    assert sorted(tuple(r) for r in top_k(spark.createDataFrame(rows, SCHEMA)).collect()) == brute(rows)


def test_empty_table(spark):
    assert top_k(spark.createDataFrame([], SCHEMA)).count() == 0
