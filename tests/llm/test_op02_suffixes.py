import hashlib
import random

import numpy as np
from cases import as_sf, edge_docs, edge_rows, empty_docs, words

from coderail.llm.op02_suffixes import COVER, MOD, WINDOW, anchors, dedup_substrings, op2_substring_suffixes
from coderail.llm.words import running


def brute(rows):
    seen, out = set(), []
    texts = sorted(((r[0], (r[1] or "").encode()) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(r[1]).hexdigest()))
    for doc_id, t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - WINDOW + 1):
            w = t[i : i + WINDOW]
            if w in seen:
                gone[i : i + WINDOW] = True
            seen.add(w)
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((doc_id, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def key(r):
    return tuple(-1 if x is None else x for x in r)


def tricky_rows():
    rng = random.Random(12)
    out, pool = [], [words(rng, 60) for _ in range(6)]
    for i in range(90):
        parts = [words(rng, rng.randint(0, 40))]
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(pool)
            a = rng.randint(0, 60)
            parts.append(p[a : a + rng.choice((90, 98, 99, 100, 101, 106, 107, 150, 250))])
            parts.append(rng.choice(("", "é", "\n", words(rng, 3))))
        out.append((1000 - 7 * i, "".join(parts)))
    out += [(2000, "ab" * 400), (2001, "ba" * 300), (2002, "a" * 99), (2003, "a" * 100), (2004, "a" * 101), (2005, "a" * 5000), (2005, "b" * 150 + "a" * 120)]
    out += [(3000 + i, pool[0] + " " + pool[1]) for i in range(12)] + [(3000, pool[0] + " " + pool[1])] * 2
    return out


def test_cover_meets_every_pair_of_residues():
    assert all(any((i + d) % MOD in COVER and (j + d) % MOD in COVER for d in range(MOD)) for i in range(MOD) for j in range(MOD))


def test_running_minimum():
    x = np.random.default_rng(1).integers(0, 50, 200)
    for w in (1, 2, 3, 5, 64, 69, 100):
        assert (running(x, w, np.minimum) == [x[i : i + w].min() for i in range(len(x) - w + 1)]).all()


def test_every_window_has_an_anchor():
    rng = random.Random(3)
    texts = [words(rng, 200).encode(), b"a" * 99, b"a" * 300, words(rng, 12).encode(), words(rng, 30).encode()]
    _, text, at = anchors(texts)
    for k, t in enumerate(texts):
        mine = set(at[text == k].tolist())
        assert all(any(i <= a <= i + WINDOW - 32 for a in mine) for i in range(len(t) - WINDOW + 1))
        assert len(t) >= WINDOW or not mine


def test_query_on_edge_documents(spark, tmp_path):
    got = [tuple(r) for r in op2_substring_suffixes(spark, as_sf(spark, edge_docs(spark), tmp_path)).collect()]
    assert sorted(got, key=key) == sorted(brute(edge_rows()), key=key)


def test_overlaps_edges_periods_and_copies(spark):
    rows = tricky_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [tuple(r) for r in dedup_substrings(docs, buckets=3, part_bytes=4000).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_kept_text(spark):
    rows = tricky_rows()
    got = dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string"), buckets=1, kept=True).collect()
    for r in got:
        assert r["kept"] is None and r["n_removed"] == 0 or hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"]


def test_empty_table(spark, tmp_path):
    assert op2_substring_suffixes(spark, as_sf(spark, empty_docs(spark), tmp_path)).count() == 0
