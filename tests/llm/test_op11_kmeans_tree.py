import math
import random

import duckdb
import numpy as np

from coderail.llm.op11_kmeans_tree import OP11_SQL, best_bins, cosines, fit, leaves_of, nearest, op11_kmeans_tree, units, widened

SCHEMA = "vec_id long, embedding array<float>, score double, rank int, leaf int, cell long, x string, qid long"
EXTRA = (0.5, 1, 2, 3, "x", 4)


def rows_of(seed=1, n=300, dims=12):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(12)]
    rows = [(i, [np.float32(c + rng.gauss(0, 0.4)).item() for c in centres[i % 12]]) for i in range(n)]
    rows += [(i + 1000, rows[7][1]) for i in range(40)]  # one vector many times
    rows += [(50, rows[3][1]), (50, rows[50][1]), (400, rows[9][1][:5]), (2000, [x * 2 for x in rows[100][1]])]
    rows += [(500, []), (600, None), (650, [1.0, None]), (700, [float("nan")] * dims), (None, rows[1][1]), (750, [float("inf")]), (800, [0.0, 0.0])]
    return [(*r, *EXTRA) for r in rows]


def brute(rows, k=5, step=50):
    longest = max((len(r[1]) for r in rows if r[1]), default=0)
    ok = [(i, np.array(e + [0.0] * (longest - len(e)))) for i, e, *_ in rows
          if i is not None and e and all(x is not None and math.isfinite(x) for x in e) and any(e)]
    out = {}
    for a, (q, u) in enumerate(ok):
        if q % step == 0:
            scores = cosines(np.stack([v for _, v in ok]), u)
            out.setdefault(q, []).append(sorted((-s, c) for b, (s, (c, _)) in enumerate(zip(scores.tolist(), ok)) if a != b)[:k])
    return {q: sorted(o) for q, o in out.items()}


def got(df):
    """Lists of (-score, id) by query id; rows with one id and different vectors are told apart by their scores."""
    by = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"], -r["score"])):
        by.setdefault(r["query_id"], []).append((r["rank"], -r["score"], r["vec_id"]))
    return by


def flat(lists):
    return {q: sorted((i, s, v) for own in o for i, (s, v) in enumerate(own, 1)) for q, o in lists.items()}


def test_all_leaves_are_brute_force(spark):
    for rows in (rows_of(), rows_of(2)[:4] + rows_of(2)[-1:]):
        df = spark.createDataFrame(rows, SCHEMA).repartition(3)
        found = nearest(df, target=1.1, leaf_rows=8, cell_rows=40, query_chunk=2)
        assert {q: sorted(o) for q, o in got(found).items()} == flat(brute(rows))


def test_recall_of_a_calibrated_search(spark, tmp_path):
    rows = rows_of(5, 2000)
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.mode("overwrite").parquet(f"{tmp_path}/embeddings.parquet")
    found, true = got(op11_kmeans_tree(spark, str(tmp_path))), flat(brute(rows))
    pairs = {(q, v, s) for q, o in true.items() for _, s, v in o}
    assert len(pairs & {(q, v, s) for q, o in found.items() for _, s, v in o}) >= 0.95 * len(pairs)
    assert all(len(found[q]) == len(true[q]) for q in true)


def test_sql_is_the_whole_result_on_a_small_table(spark):
    sf = "/root/testdata/sf0.01"
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
        assert sorted(tuple(r) for r in op11_kmeans_tree(spark, sf).collect()) == sorted(db.execute(OP11_SQL).fetchall())


def test_best_bins_visit_every_leaf_once_own_leaf_first():
    x = units(np.random.default_rng(4).normal(0, 1, (900, 8)))
    tree = fit(x, 4, 10)
    own = leaves_of(tree, x)
    leaves = set(np.flatnonzero(tree.children == 0).tolist())
    for order, leaf in zip(best_bins(tree, x[:50], 10**6), own):
        assert order[0] == leaf and len(order) == len(leaves) and set(order) == leaves
    assert [len(o) for o in best_bins(tree, x[:5], 3)] == [3] * 5
    assert len(fit(np.ones((500, 3)) / 3**0.5).first) == 1  # equal vectors stay one leaf


def test_visits_widen_until_the_recall_is_reached():
    ranks = np.array([0] * 90 + [9] * 9 + [60])
    assert widened(ranks, 100, 0.9) == 1 and 10 <= widened(ranks, 100, 0.95) <= 12 and widened(ranks, 100, 1.0) > 60 and widened(ranks, 100, 1.1) == 100


def test_empty_table(spark):
    assert nearest(spark.createDataFrame([], SCHEMA)).count() == 0
    assert nearest(spark.createDataFrame([(1, [1.0, 2.0], *EXTRA)], SCHEMA)).count() == 0
    assert nearest(spark.createDataFrame([(50, [1.0, 2.0], *EXTRA)], SCHEMA)).count() == 0
