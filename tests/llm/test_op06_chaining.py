import random

import numpy as np
from cases import as_sf, edge_docs, edge_rows, empty_docs
from pyspark.sql import functions as F

from coderail.llm.op06_chaining import K, WINDOW, batch_seeds, beside, chain, edit_matches, extend, may_extend, op6_fuzzy_passages, text_seeds, without_passages
from coderail.llm.words import Batch

VOCABULARY = ["".join(random.Random(5 * i).choice("abcdefghijklmnop") for _ in range(6)) for i in range(3000)]


def brute_chain(fragments, cost, max_gap):
    """Best score of a chain, every predecessor tried."""
    order = sorted(range(len(fragments)), key=lambda i: fragments[i][:2])
    score = {}
    for i in order:
        x, y, m = fragments[i]
        score[i] = m + max([0, *(score[j] - cost * (x - jx - jm + y - jy - jm) for j, (jx, jy, jm) in enumerate(fragments)
                                 if j in score and jx + jm <= x and jy + jm <= y and x - jx - jm <= max_gap and y - jy - jm <= max_gap)])
    return max(score.values())


def test_fenwick_chains_reach_the_brute_force_score():
    rng = random.Random(1)
    for _ in range(60):
        fragments = list({(rng.randrange(300), rng.randrange(300), rng.randrange(8, 30)) for _ in range(rng.randint(1, 14))})
        got = chain(fragments, 0.5, 10**6)
        assert sorted(i for c in got for i in c) == list(range(len(fragments)))

        def value(c):
            total = sum(fragments[i][2] for i in c)
            for i, j in zip(c, c[1:]):
                (x, y, m), (u, v, _) = fragments[i], fragments[j]
                assert x + m <= u and y + m <= v
                total -= 0.5 * (u - x - m + v - y - m)
            return total

        assert abs(max(map(value, got)) - brute_chain(fragments, 0.5, 10**6)) < 1e-9


def test_chains_reach_the_brute_force_score_with_short_gaps():
    rng = random.Random(8)
    for _ in range(400):
        fragments = list({(rng.randrange(200), rng.randrange(200), rng.choice((8, 9, 16, 60))) for _ in range(rng.randint(1, 25))})
        got = chain(fragments, 0.5, 40)
        assert sorted(i for c in got for i in c) == list(range(len(fragments)))
        steps = [(fragments[i], fragments[j]) for c in got for i, j in zip(c, c[1:])]
        assert all(0 <= u - x - m <= 40 and 0 <= v - y - m <= 40 for (x, y, m), (u, v, _) in steps)
        score = max(sum(fragments[i][2] for i in c) - 0.5 * sum(fragments[j][0] + fragments[j][1] - sum(fragments[i][:2]) - 2 * fragments[i][2] for i, j in zip(c, c[1:])) for c in got)
        assert abs(score - brute_chain(fragments, 0.5, 40)) < 1e-9
    behind = [(0, 0, 200)] + [(260 + 12 * i, 260 + 12 * i, 8) for i in range(6)]  # 60 words behind a longer passage
    assert sorted(map(len, chain(behind))) == [1, 6]


def test_alignment_pieces():
    assert edit_matches(list("abcd"), list("abxd")) == 3 and edit_matches([], list("ab")) == 0 and edit_matches(list("abc"), list("bc")) == 2
    assert extend(list("abcXef"), list("abcYef")) == (3, 3, 3) and extend(list("aaaaXbbbb"), list("aaaaYbbbb")) == (9, 9, 8)
    assert extend(list("abcdXYefgh"), list("abcdefgh")) == (10, 8, 8) and extend([], list("ab")) == (0, 0, 0)


def test_runs_of_equal_words_share_a_seed():
    rng = random.Random(2)
    for _ in range(20):
        run = rng.choices(VOCABULARY, k=K + WINDOW - 1)
        a, b = (" ".join(rng.choices(VOCABULARY, k=20) + run + rng.choices(VOCABULARY, k=9)) for _ in range(2))
        h, text, at, lead = text_seeds([a, b, "", None])
        assert {x for x, t in zip(h, text) if t == 0} & {x for x, t in zip(h, text) if t == 1} and lead.all()


def planted(seed=7, docs=80):
    rng = random.Random(seed)
    passages = [rng.choices(VOCABULARY, k=rng.choice((60, 80, 120))) for _ in range(6)]
    rows, where = [], {}
    for i in range(docs):
        w = rng.choices(VOCABULARY, k=rng.randint(20, 200))
        kind = rng.choice(("clean", "exact", "fuzzy"))
        if kind != "clean":
            p = rng.randrange(6)
            part = list(passages[p])
            if kind == "fuzzy":
                for at in range(22, len(part) - 10, 28):
                    part[at] = rng.choice(VOCABULARY)
                del part[len(part) // 2 + 3]
            at = rng.randint(0, len(w))
            w[at:at] = part
            where.setdefault(p, []).append((i, at, at + len(part)))
        rows.append((i, " ".join(w).replace(" ", "\n", 1)))
    return rows, where


def test_planted_passages_are_found_and_clean_documents_left_alone(spark):
    rows, where = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    later = {i: (a, b) for spots in where.values() for i, a, b in spots[1:]}
    kept = {r["doc_id"]: r["text"].split() for r in without_passages(docs).collect()}
    for i, text in rows:
        words = text.split()
        if i in later:
            a, b = later[i]
            gone = len(words) - len(kept[i])
            assert abs(gone - (b - a)) <= 6, (i, gone, b - a)
            assert kept[i][: max(0, a - 3)] == words[: max(0, a - 3)]
        else:
            assert kept[i] == words


def test_a_passage_split_between_two_earlier_documents_is_found(spark):
    rng = random.Random(3)
    p = rng.choices(VOCABULARY, k=64)
    fill = lambda n: rng.choices(VOCABULARY, k=n)
    rows = [(1, " ".join(fill(30) + p[:32] + fill(30))), (2, " ".join(fill(9) + p)), (3, " ".join(fill(20) + p + fill(20)))]
    got = {r["doc_id"]: len(r["text"].split()) for r in without_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 92, 2: 73, 3: 40}


def test_exact_passages_with_other_words_between_them_are_found(spark):
    fresh = (f"w{i}" for i in range(10**6))
    fill = lambda n: [next(fresh) for _ in range(n)]
    rows, runs = [], {}
    for i, (m, n, between) in enumerate(((3, 55, 30), (2, 52, 30), (4, 60, 38))):
        runs[2 * i] = [fill(n) for _ in range(m)]
        rows += [(d, " ".join(fill(25) + sum((p + fill(between) for p in runs[2 * i]), []))) for d in (2 * i, 2 * i + 1)]
    kept = {r["doc_id"]: set(r["text"].split()) for r in without_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, made in runs.items():
        others = set(dict(rows)[i + 1].split()) - set(sum(made, []))
        assert others <= kept[i + 1] and kept[i + 1] == others, i


def test_seeds_are_left_out_only_where_nothing_extends():
    rng, kept, n = random.Random(12), 0, 0
    for _ in range(300):
        letters = rng.choice(("abc", "abcdefghijklmnopqrstuvwxyz"))
        texts = [" ".join(rng.choices(letters, k=rng.randint(0, 30)) + [f"s{i}" for i in range(15)] + rng.choices(letters, k=rng.randint(0, 30))) for _ in range(2)]
        batch, (a, b) = Batch(texts), [t.split() for t in texts]
        h, text, at, _ = batch_seeds(batch)
        code = beside(batch, text, at)
        for i in np.flatnonzero(text == 0):
            for j in np.flatnonzero((text == 1) & (h == h[i])):
                x, y = int(at[i]), int(at[j])
                far = extend(a[x + K :][:50], b[y + K :][:50])[0] or extend(a[:x][::-1][:50], b[:y][::-1][:50])[0]
                got = may_extend(code[i : i + 1], code[j : j + 1])[0]
                assert got or not far
                kept, n = kept + got, n + 1
    a, b = np.random.default_rng(1).integers(0, 1 << 60, (2, 20000))
    assert n > 300 and may_extend(a, b).mean() < 0.4


def test_passages_that_share_one_seed_are_found(spark):
    fresh = (f"w{i}" for i in range(10**6))
    fill = lambda n: [next(fresh) for _ in range(n)]
    rows, one = [], []
    for i in range(150):
        p = fill(72)
        q = [next(fresh) if k % 10 == 9 else w for k, w in enumerate(p)]
        rows += [(2 * i, " ".join(fill(20) + p + fill(20))), (2 * i + 1, " ".join(fill(20) + q + fill(20)))]
        h, text, _, _ = text_seeds([rows[-2][1], rows[-1][1]])
        if len(set(h[text == 0]) & set(h[text == 1])) == 1:
            one.append(2 * i + 1)
    got = {r["doc_id"]: len(r["text"].split()) for r in without_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(one) > 5 and all(got[i] < 60 for i in one), [got[i] for i in one]


def test_a_passage_of_stock_lines_first_seen_elsewhere_is_found(spark):
    fresh = (f"w{i}" for i in range(10**6))
    fill = lambda n: [next(fresh) for _ in range(n)]
    lines = [fill(10) for _ in range(6)]
    rows = [(i, " ".join(fill(20) + line + fill(20))) for i, line in enumerate(lines)]
    rows += [(i, " ".join(fill(20) + sum(lines, []) + fill(20))) for i in (10, 11)]
    got = {r["doc_id"]: len(r["text"].split()) for r in without_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {**dict.fromkeys(range(6), 50), 10: 100, 11: 40}


def test_a_passage_whose_every_short_run_is_first_seen_elsewhere_is_found(spark):
    fresh = (f"w{i}" for i in range(10**6))
    fill = lambda n: [next(fresh) for _ in range(n)]
    lines = [fill(10) for _ in range(6)]
    rows = [(i, " ".join(fill(20) + lines[i] + lines[i + 1] + fill(20))) for i in range(5)]  # the 8-word seeds over line ends too
    rows += [(i, " ".join(fill(20) + sum(lines, []) + fill(20))) for i in (10, 11)]
    got = {r["doc_id"]: len(r["text"].split()) for r in without_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {**dict.fromkeys(range(5), 60), 10: 100, 11: 40}


def test_texts_that_repeat_themselves(spark):
    rng = random.Random(5)
    run = ["and"] * 120 + ["x", "y", "z"] * 40
    rows = [(i, " ".join(rng.choices(VOCABULARY, k=15) + run[: 200 + i] + rng.choices(VOCABULARY, k=15))) for i in range(4)]
    got = {r["doc_id"]: len(r["text"].split()) for r in without_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == 230 and all(30 <= got[i] <= 36 for i in (1, 2, 3)), got


def test_edge_documents(spark, tmp_path):
    got = op6_fuzzy_passages(spark, as_sf(spark, edge_docs(spark), tmp_path)).collect()
    rows = edge_rows()
    passage = rows[11][1].split()
    hit = {(r["doc_id"], r["end_word"] - r["start_word"], r["first_doc_id"]) for r in got}
    assert {(33, 60, None), (36, 60, None), (39, 60, None)} <= hit and len(passage) == 60
    assert sum(r["doc_id"] == 30 for r in got) >= 2 and any(r["doc_id"] == 57 for r in got)
    kept = without_passages(edge_docs(spark))
    assert kept.columns == edge_docs(spark).columns and kept.count() == len(rows)
    by = {r["doc_id"]: r for r in kept.where("doc_id is not null").collect()}
    assert by[33]["text"] == "" and by[33]["n_chars"] == 0 and by[36]["text"] == rows[12][1].split("\n")[0] + "\n"
    assert by[0]["text"] is None and by[42]["text"] == rows[14][1]


def test_empty_table(spark, tmp_path):
    assert op6_fuzzy_passages(spark, as_sf(spark, empty_docs(spark), tmp_path)).count() == 0
    assert without_passages(empty_docs(spark)).agg(F.count("*")).first()[0] == 0
    assert np.array_equal(text_seeds([])[0], [])
