import random
import re

import numpy as np
import pytest
import xxhash
from cases import as_sf, edge_docs, edge_rows, empty_docs
from pyspark.sql import functions as F

from coderail.llm.components import components
from coderail.llm.op05_simhash import allocate, fingerprint, links, near_duplicates_kept, op5_simhash


def plain_print(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    sh = [" ".join(w)] if len(w) < 4 else [" ".join(w[i : i + 4]) for i in range(len(w) - 3)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows):
    fp = [plain_print(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= 4:
                root[find(i)] = find(j)
    first = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            first[find(i)] = min(first.get(find(i), r[0]), r[0])
    return [(r[0], f"{fp[i]:016x}", first.get(find(i))) for i, r in enumerate(rows)]


def key(r):
    return tuple((x is not None, x or 0) for x in r)


def many_rows():
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdef") for _ in range(5)) for _ in range(400)]
    out = []
    for i in range(120):
        w = rng.choices(vocabulary, k=120)
        for _ in range(rng.choice((1, 1, 2, 5))):
            out.append((len(out), " ".join(w)))
            w = list(w)
            w[rng.randrange(120)] = rng.choice(vocabulary)
    return out


@pytest.mark.parametrize("rows", [edge_rows(), [(*r, *[None] * 15) for r in many_rows()]], ids=["edge", "near copies"])
def test_query_equals_brute_force(spark, tmp_path, rows):
    docs = spark.createDataFrame(rows, edge_docs(spark).schema)
    got = [tuple(r) for r in op5_simhash(spark, as_sf(spark, docs, tmp_path)).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
    kept = near_duplicates_kept(docs)
    assert kept.columns == docs.columns
    want = {c for _, _, c in brute(rows)}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want) and None not in want


def test_links_are_complete_for_dense_and_correlated_bits(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 62, 40)
    fps = {int(b) for b in base}
    for b in base:
        for _ in range(10):
            fps.add(int(b) ^ sum(1 << int(k) for k in rng.choice(63, rng.integers(1, 5), replace=False)))
    fps |= {-1, -2, 0, 1, 2, 3}
    for limit in (2, 4):
        got = {tuple(r) for r in links(spark.createDataFrame([(x,) for x in fps], "fp long"), limit).collect()}
        u = sorted(fps)
        want = {(a, b) for i, a in enumerate(u) for b in u[i + 1 :] if ((a ^ b) & (1 << 64) - 1).bit_count() <= limit}
        assert got == want


def test_thresholds_keep_the_pigeonhole_sum():
    sample = np.random.default_rng(1).integers(-(1 << 63), (1 << 63) - 1, 2000)
    for total in (100, 10**6, 10**9):
        plan = allocate(sample, total)
        assert sorted(b for g, _ in plan for b in g) == list(range(64))
        assert sum(t for _, t in plan) == 4 - len(plan) + 1


def test_fingerprint_equals_the_plain_form():
    for r in edge_rows():
        assert fingerprint(r[1]) & (1 << 64) - 1 == plain_print(r[1])


def test_components_of_paths_stars_and_cycles(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    edges += [(rng.randint(400, 480), rng.randint(400, 480)) for _ in range(40)]
    rng.shuffle(edges)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert got == {x: r for x, r in label.items() if any(x in e and e[0] != e[1] for e in edges)}


def test_empty_table(spark, tmp_path):
    docs = empty_docs(spark)
    assert op5_simhash(spark, as_sf(spark, docs, tmp_path)).count() == 0
    assert near_duplicates_kept(docs).agg(F.count("*")).first()[0] == 0
