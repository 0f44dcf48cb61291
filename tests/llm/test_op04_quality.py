import random
import re
from collections import Counter

import numpy as np
from cases import as_sf, edge_docs, edge_rows, empty_docs, words

from coderail.llm.op04_quality import calibrate, judge, model_of, op4_quality_rules

SF = "/root/testdata/sf0.01"


def base(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(zip(w, w[1:], w[2:], w[3:], w[4:]))
    hit = {i + k for i, g in enumerate(zip(w, w[1:], w[2:], w[3:], w[4:])) if grams[g] > 1 for k in range(5)}
    failed = len(w) < 10 or 100 * len(hit) > 20 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit), failed)


def test_base_counts_on_edge_documents(spark, tmp_path):
    rng = random.Random(8)
    more = [(1000 + i, words(rng, 80, "ab", 2) + "\n" + words(rng, 5) + "\n a b\n a b\n#$% <x>", *[None] * 15) for i in range(30)]
    docs = edge_docs(spark).union(spark.createDataFrame(more, edge_docs(spark).schema))
    sf = as_sf(spark, docs, tmp_path)
    spark.createDataFrame([(3, 1, 0), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    key = lambda r: tuple(-1 if x is None else x for x in r)
    rows = op4_quality_rules(spark, sf).collect()
    assert sorted((tuple(r)[:7] for r in rows), key=key) == sorted(((r[0], *base(r[1])) for r in edge_rows() + more), key=key)
    assert all(r["kept"] == (not r["base_failed"]) for r in rows)  # no labels of both kinds: the base rules decide


def test_held_out_accuracy_and_columns(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    train, test = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    out = judge(docs, model_of(docs, train))
    assert out.columns == [*docs.columns, "q_"]
    rows = out.join(test, "doc_id").where("not q_.base_failed").select("quality", "q_.probability", "q_.kept").collect()
    hit = np.mean([r["kept"] == (r["quality"] == 1) for r in rows])
    clean = np.mean([r["kept"] for r in rows if r["quality"] == 1])
    assert hit > 0.95 and clean > 0.97, (hit, clean)


def test_training_is_repeatable(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    a, b = model_of(docs, labels), model_of(docs.repartition(7), labels.repartition(3))
    assert (a[0] == b[0]).all() and a[1:] == b[1:]


def test_calibration_recovers_a_logistic_curve():
    rng = np.random.default_rng(1)
    z = rng.normal(0, 2, 20000)
    y = (rng.random(20000) < 1 / (1 + np.exp(-(1.5 * z - 0.7)))).astype(float)
    a, b = calibrate(z, y)
    assert abs(a - 1.5) < 0.1 and abs(b + 0.7) < 0.1


def test_empty_table(spark, tmp_path):
    sf = as_sf(spark, empty_docs(spark), tmp_path)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    assert op4_quality_rules(spark, sf).count() == 0
