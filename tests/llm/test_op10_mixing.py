import random
import re

import numpy as np
from cases import as_sf, edge_docs, edge_rows, empty_docs

from coderail.llm.op10_mixing import fit, mix, mixed_documents, op10_mixing


def brute_targets(sizes):
    """Level filling by repeated resharing; sizes by source in order."""
    weights = {s: i % 3 + 1 for i, s in enumerate(sizes)}
    total, open_, out = sum(sizes.values()), list(sizes), {}
    while open_:
        left = total - sum(out.values())
        level = left / sum(weights[s] for s in open_)
        over = [s for s in open_ if weights[s] * level > 3 * sizes[s]]
        if not over:
            return out | {s: weights[s] * level for s in open_}
        for s in over:
            out[s] = 3 * sizes[s]
            open_.remove(s)
    return out


def test_fit_is_exact_where_a_brute_force_sum_is():
    rng = random.Random(4)
    for _ in range(40):
        sizes = np.array(rng.sample(range(1, 30), 4))
        counts = np.array([rng.randint(0, 4) for _ in range(4)])
        sums = {0}
        for s, c in zip(sizes, counts):
            sums = {x + k * int(s) for x in sums for k in range(c + 1)}
        budget = rng.randint(0, int(sizes @ counts) + 5)
        take = fit(sizes, counts, budget)
        assert ((0 <= take) & (take <= counts)).all()
        got = int(sizes @ take)
        assert got <= budget and max(x for x in sums if x <= budget) - got <= int(sizes.max())
    big = fit(np.arange(1, 3000), np.full(2999, 50), 111_111_111)
    assert int(np.arange(1, 3000) @ big) == 111_111_111


def test_query_on_edge_documents(spark, tmp_path):
    sf = as_sf(spark, edge_docs(spark), tmp_path)
    rows = [tuple(r) for r in op10_mixing(spark, sf).collect()]
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(rows, key=key) == sorted((tuple(r) for r in op10_mixing(spark, sf).collect()), key=key)
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in edge_rows()]
    assert sorted((-1 if r[0] is None else r[0], n) for r, n in zip(edge_rows(), size)) == sorted((-1 if r[0] is None else r[0], r[1]) for r in rows)
    sources = {}
    for s in sorted({r[3] for r in edge_rows()}, key=lambda s: (s is None, s or "")):
        sources[s] = sum(n for r, n in zip(edge_rows(), size) if r[3] == s)
    want = brute_targets(sources)
    assert sorted({(r[2], round(r[3], 6)) for r in rows}) == sorted({(sources[s], round(want[s], 6)) for s in want})
    assert all(r[4] <= 3 * r[1] and (r[1] == 0 or r[4] % r[1] == 0) for r in rows)


def test_many_lengths_meet_the_target_exactly(spark):
    rng = random.Random(9)
    docs = spark.createDataFrame([(i, "w " * rng.randint(1, 60), "abc"[i % 3 if i % 2 else 0]) for i in range(900)], "doc_id long, text string, source string")
    rows = mix(docs).collect()
    by = {}
    for r in rows:
        by.setdefault((r["doc"]["source"], r["target"]), []).append(r["copies"] * r["size"])
        assert 0 <= r["copies"] <= 3
    assert all(abs(sum(v) - target) <= 1 for (_, target), v in by.items())
    assert mixed_documents(docs).count() == sum(r["copies"] for r in rows)
    assert mixed_documents(docs).columns == docs.columns


def test_empty_table(spark, tmp_path):
    assert op10_mixing(spark, as_sf(spark, empty_docs(spark), tmp_path)).count() == 0
