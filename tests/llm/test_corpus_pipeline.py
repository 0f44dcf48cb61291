import zlib

import numpy as np
import pytest
from cases import as_sf, edge_docs, edge_rows, empty_docs
from tokenizers import Tokenizer

import corpus_pipeline
from coderail.llm.op04_quality import judge, model_of
from coderail.llm.tokens import default_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage returned for the test table, written and read again."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        columns = docs.columns
        made = stage(spark, docs, SF)
        assert k == len(corpus_pipeline.STAGES) - 1 or made.columns == columns
        made.write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_quality_keeps_what_the_operator_keeps(spark, stages):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = judge(docs, model_of(docs, spark.read.parquet(f"{SF}/labels.parquet"))).where("q_.kept")
    assert sorted(r["doc_id"] for r in stages[0].collect()) == sorted(r["doc_id"] for r in want.collect())
    assert 0 < stages[0].count() < docs.count()


def test_one_document_of_each_group_stays(spark, stages):
    from test_op05_simhash import brute

    rows = [(r["doc_id"], r["text"]) for r in stages[0].collect()]
    assert sorted(r["doc_id"] for r in stages[1].collect()) == sorted({c for _, _, c in brute(rows)})


def test_passages_go_and_the_rest_stays(stages):
    before = {r["doc_id"]: r for r in stages[1].collect()}
    after = {r["doc_id"]: r for r in stages[2].collect()}
    assert before.keys() == after.keys()
    for i, r in after.items():
        if r["text"] == before[i]["text"]:
            assert r == before[i]
        else:
            words, old = r["text"].split(), iter(before[i]["text"].split())
            assert r["n_chars"] == len(r["text"]) and all(w in old for w in words)  # a subsequence of the words


def test_copies_and_packed_ids(spark, stages):
    rows = [tuple(r) for r in stages[3].collect()]
    source = [tuple(r) for r in stages[2].collect()]
    assert set(rows) <= set(source) and max(rows.count(r) for r in rows) <= 3 * max(source.count(r) for r in source)
    tk, want = Tokenizer.from_file(default_path()), []
    for r in stages[3].collect():
        ids = tk.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        want += [(r["doc_id"], s, zlib.crc32(np.array(ids[s : s + 4096], "<u4").tobytes()), len(ids)) for s in range(0, len(ids), 4096)]
    got = [(r["doc_id"], r["start"], r["ids_crc32"], r["doc_tokens"]) for r in stages[4].collect()]
    assert sorted(got) == sorted(want)


def test_run_equals_the_stages(spark, stages):
    key = ["doc_id", "start", "ids_crc32", "length", "doc_tokens"]
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).select(key).collect())) == sorted(map(tuple, stages[4].select(key).collect()))


def test_edge_documents_and_empty_table(spark, tmp_path):
    for name, docs in (("a", edge_docs(spark)), ("b", empty_docs(spark))):
        sf = as_sf(spark, docs, tmp_path / name)
        spark.createDataFrame([(3, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
        out = corpus_pipeline.run(spark, sf)
        assert (out.count() > 0) == (name == "a")
    assert len(edge_rows()) > 20
