import random

from cases import as_sf, edge_docs, edge_rows, empty_docs, words

from coderail.llm.op03_token_counts import count_tokens, cut, default_path, op3_token_counts, processor, spliceable


def want(rows, limit=4096):
    sp = processor(default_path())
    out = [(r[0], len((r[1] or "").encode()), len(sp.encode(r[1] or ""))) for r in rows]
    return sorted(((-1 if d is None else d, b, n, n > limit) for d, b, n in out))


def got(df):
    return sorted((-1 if r[0] is None else r[0], *r[1:]) for r in df.collect())


def test_query_equals_the_library(spark, tmp_path):
    assert got(op3_token_counts(spark, as_sf(spark, edge_docs(spark), tmp_path))) == want(edge_rows())


def test_spliced_counts_equal_whole_counts(spark):
    rng = random.Random(6)
    texts = [words(rng, 2000), "x" * 5000, "x" * 900 + " " + words(rng, 300), ("ab   cd\n" * 400), " " * 3000, "▁ ▁" * 900,
             "日本語 テキスト " * 200 + "éñ😀" * 300, words(rng, 50) + " " * 400 + words(rng, 50) + "<s> </s>" * 90]
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert spliceable(default_path())
    for chunk, overlap in ((64, 4), (200, 16), (1000, 64)):
        assert got(count_tokens(docs, default_path(), 100, chunk, overlap)) == want(rows, 100)
    assert len(cut(texts[0], 200, 16)) > 20 and len(cut(texts[1], 200, 16)) == 1


def test_empty_table(spark, tmp_path):
    assert op3_token_counts(spark, as_sf(spark, empty_docs(spark), tmp_path)).count() == 0
