import math
import random
import re
from collections import Counter

import duckdb
import numpy as np

from cases import edge_docs, edge_rows, empty_docs, words
from coderail.llm.op13_lexical import OP13_SQL, TERM, accumulate, build_index, op13_lexical_search, query_terms, search, terms_of

ITEMS = "item_id long, text string, score long, rank int, doc_id string, term string, shard int"


def split(text):
    return re.findall(TERM, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=10):
    docs = [(r[0], split(r[1])) for r in docs]
    n_docs, n_terms = sum(bool(t) for _, t in docs), sum(len(t) for _, t in docs)
    df = Counter(w for _, t in docs for w in set(t))
    out = []
    for item in items:
        scores = []
        for doc_id, terms in docs:
            tf, score = Counter(terms), 0
            for w in set(split(item[1])) & set(terms):
                m = 100 - 90 + (90 * len(terms) * n_docs) // n_terms
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((1000000000 * tf[w]) // (1000 * tf[w] + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        out += [(item[0], r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def item_rows(seed=1):
    rng = random.Random(seed)
    docs = edge_rows(1)
    texts = [None, "", " ;;! ", "a", "A b C", "Ünï çödé", "x" * 3000, "don't we'll 12345", docs[11][1], docs[14][1][:80], "nosuchterm", "null id"]
    texts += [" ".join(rng.sample(docs[10][1].split(), 30)) for _ in range(4)] + [words(rng, 20)]
    rows = [(i, t, 1, 2, "d", "t", 3) for i, t in enumerate(texts)]
    return rows + [rows[8], (None, "a b c", 1, 2, "d", "t", 3)]


def as_tables(spark, docs, items, folder):
    docs.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, ITEMS).repartition(2).write.mode("overwrite").parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_terms_are_those_of_the_pattern():
    for text in [*(r[1] for r in edge_rows() if r[1]), "".join(map(chr, range(1, 300))), "ÀÉ İstanbul Kelvin K"]:
        assert [t.decode() for t in terms_of(text.encode())] == split(text)


def test_query_equals_brute_force_and_sql(spark, tmp_path):
    sf = as_tables(spark, edge_docs(spark), item_rows(), tmp_path)
    result = got(op13_lexical_search(spark, sf))
    assert result == brute(edge_rows(), item_rows())
    with duckdb.connect() as db:
        for name in ("documents", "benchmark"):
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet/*.parquet'")
        assert sorted(db.execute(OP13_SQL).fetchall(), key=str) == result


def test_small_shards_and_blocks(spark):
    index = build_index(edge_docs(spark), shard_docs=2)
    asked = query_terms(spark.createDataFrame(item_rows(2), ITEMS), block_terms=20)
    assert asked.select("block").distinct().count() > 2
    assert got(search(index, asked, 3, seed_shards=2)) == brute(edge_rows(), item_rows(2), 3)


def test_accumulators_stop_and_scores_stay_exact():
    rng = np.random.default_rng(3)
    stopped = 0
    for _ in range(50):
        postings = []
        for size in (3, 15, 40, 200, 300):
            places = np.sort(rng.choice(300, size, replace=False))
            postings.append((places, rng.integers(1, 4000 // size, size)))
        total = np.zeros(300, np.int64)
        for p, g in postings:
            total[p] += g
        docs, score, closed = accumulate(postings, 300, 10)
        stopped += closed < 5
        assert (total[docs] == score).all()
        assert sorted(score, reverse=True)[:10] == sorted(total, reverse=True)[:10]
        assert set(np.flatnonzero(total >= np.sort(total)[-10])) <= set(docs.tolist())
        above, s, c = accumulate(postings, 300, 10, int(np.sort(total)[-10]))
        assert c <= closed and (total[above] == s).all() and set(np.flatnonzero(total >= np.sort(total)[-10])) <= set(above.tolist())
    assert stopped > 25


def test_empty_tables(spark, tmp_path):
    assert op13_lexical_search(spark, as_tables(spark, empty_docs(spark), item_rows(), tmp_path / "a")).count() == 0
    assert op13_lexical_search(spark, as_tables(spark, edge_docs(spark), [], tmp_path / "b")).count() == 0
