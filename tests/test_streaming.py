"""Incremental coding: two micro-batches, repeated titles, and a replayed batch."""

import os
import tempfile

from pyspark.sql import functions as F

from coderail.operators import infer
from coderail.plans import stages as P
from coderail.plans.fixtures import fixture
from coderail.streaming import incremental
from core_helpers import SF_SMALL

SCHEMA = "ordinal bigint, title string, description string"


def test_two_batches_and_replay(spark):
    root = tempfile.mkdtemp(prefix="coderail-stream-")
    src = os.path.join(root, "src")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(
        F.col("doc_id").alias("ordinal"), F.substring("text", 1, 24).alias("title"), F.col("text").alias("description"))
    first = docs.filter(F.col("ordinal") < 100)
    # the second file repeats ten titles of the first one under new ordinals
    again = first.filter(F.col("ordinal") < 10).withColumn("ordinal", F.col("ordinal") + 100000)
    second = docs.filter(F.col("ordinal") >= 100).unionByName(again)
    first.coalesce(1).write.parquet(os.path.join(src, "part=1"))
    second.coalesce(1).write.parquet(os.path.join(src, "part=2"))

    sel, scheme = fixture(spark, SF_SMALL, "selected"), P.task_scheme(spark, SF_SMALL)
    store = os.path.join(root, "store")
    q = incremental.start(spark, src, schema=SCHEMA, selected=sel, scheme=scheme, infer_fn=infer.rule_scorer,
                          store=store, checkpoint=os.path.join(root, "ckpt"), max_files_per_trigger=1,
                          transform=lambda df: df.select("ordinal", "title", "description"))
    q.awaitTermination()
    resp = incremental.stored_responses(spark, store)
    n_batches = resp.select("batch_id").distinct().count()
    assert n_batches == 2
    expected = docs.select("title").distinct().count() * 3
    assert resp.count() == expected
    assert resp.select("prompt_hash", "model", "temperature").distinct().count() == resp.count()

    # replaying batch 1 rewrites its own folder and adds nothing
    batch1 = spark.read.parquet(os.path.join(src, "part=2")).select("ordinal", "title", "description")
    incremental.code_batch(batch1, 1, selected=sel, scheme=scheme, infer_fn=infer.rule_scorer, store=store,
                           model="rule-scorer", temperature=0.0)
    assert incremental.stored_responses(spark, store).count() == expected


def test_failed_pairs_and_new_categories_come_back(spark, tmp_path):
    texts = [spark.createDataFrame([(10 * b + i, f"t{b}{i}", "x" * (i + 1)) for i in range(5)], SCHEMA) for b in range(3)]
    scheme = P.task_scheme(spark, SF_SMALL)
    pick = lambda *keys: spark.createDataFrame(list(enumerate(keys, 1)), "ordinal int, key string")

    def down(request):
        raise ConnectionError("model unavailable")
    store, common = str(tmp_path / "store"), dict(scheme=scheme, model="m", temperature=0.0, backoff=0.0)
    incremental.code_batch(texts[0], 0, selected=pick("quality"), infer_fn=down, store=store, **common)
    assert incremental.stored_responses(spark, store).filter("error IS NULL").count() == 0
    incremental.code_batch(texts[1], 1, selected=pick("quality", "Beleidigung"), infer_fn=infer.rule_scorer, store=store, **common)
    got = incremental.stored_responses(spark, store).filter("error IS NULL")
    assert sorted((r.title, r.category) for r in got.collect()) == sorted(
        (f"t{b}{i}", c) for b in (0, 1) for i in range(5) for c in ("quality", "toxic"))
    incremental.code_batch(texts[2].union(texts[0]), 2, selected=pick("quality", "toxic"), infer_fn=infer.rule_scorer, store=store, **common)
    last = incremental.stored_responses(spark, store).filter("batch_id = 2")
    assert sorted((r.title, r.category) for r in last.collect()) == sorted((f"t2{i}", c) for i in range(5) for c in ("quality", "toxic"))


def test_a_category_dropped_and_selected_again_reaches_the_texts_between(spark, tmp_path):
    texts = [spark.createDataFrame([(10 * b + i, f"t{b}{i}", "x" * (i + 1)) for i in range(3)], SCHEMA) for b in range(3)]
    pick = lambda *keys: spark.createDataFrame(list(enumerate(keys, 1)), "ordinal int, key string")
    store = str(tmp_path / "store")
    for b, keys in enumerate((("quality", "toxic"), ("quality",), ("quality", "toxic"))):
        incremental.code_batch(texts[b], b, selected=pick(*keys), infer_fn=infer.rule_scorer, store=store,
                               scheme=P.task_scheme(spark, SF_SMALL), model="m", temperature=0.0, backoff=0.0)
    got = sorted((r.batch_id, r.title, r.category) for r in incremental.stored_responses(spark, store).collect())
    assert got == sorted([(b, f"t{b}{i}", c) for b in range(3) for i in range(3) for c in ("quality", "toxic") if (b, c) != (1, "toxic")]
                         + [(2, f"t1{i}", "toxic") for i in range(3)])


def test_a_batch_reads_its_own_texts_and_what_is_open(spark, tmp_path):
    """The pairs table of a batch holds new texts and open pairs only, however much came before."""
    pick = spark.createDataFrame([(1, "quality")], "ordinal int, key string")
    store = str(tmp_path / "store")

    def scorer(request):
        if request["title"] == "t0-3":
            raise ConnectionError("down")
        return infer.rule_scorer(request)
    for b in range(4):
        texts = spark.createDataFrame([(10 * b + i, f"t{b}-{i}", "x" * (i + 1)) for i in range(5)], SCHEMA)
        incremental.code_batch(texts, b, selected=pick, infer_fn=scorer if b < 3 else infer.rule_scorer, store=store,
                               scheme=P.task_scheme(spark, SF_SMALL), model="m", temperature=0.0, backoff=0.0)
    pairs = {(r.batch_id, r.title) for r in spark.read.parquet(f"{store}/pairs").collect()}
    assert pairs == {(b, f"t{b}-{i}") for b in range(4) for i in range(5)} | {(b, "t0-3") for b in (1, 2, 3)}
    got = incremental.stored_responses(spark, store)
    assert got.filter("error IS NULL").count() == 20 and got.filter("error IS NOT NULL").count() == 3
    assert spark.read.parquet(f"{store}/open").filter("batch_id = 3").count() == 0


def test_a_killed_batch_pays_for_the_rest_only(spark, tmp_path):
    """The log of a killed attempt at a batch is taken in by its replay."""
    import pytest

    from coderail.sources.answers import CallLog
    pick = spark.createDataFrame([(1, "quality")], "ordinal int, key string")
    texts = spark.createDataFrame([(i, f"t{i}", "x" * (i + 1)) for i in range(6)], SCHEMA)
    store, calls = str(tmp_path / "store"), str(tmp_path / "calls")
    os.mkdir(calls)

    def scorer(request):
        open(os.path.join(calls, request["title"] + f"-{len(os.listdir(calls))}"), "w").close()
        return infer.rule_scorer(request)
    args = dict(selected=pick, infer_fn=scorer, store=store, scheme=P.task_scheme(spark, SF_SMALL), model="m", temperature=0.0, backoff=0.0)
    drop = CallLog.drop
    CallLog.drop = staticmethod(lambda path: (_ for _ in ()).throw(RuntimeError("killed")))
    try:
        with pytest.raises(RuntimeError, match="killed"):
            incremental.code_batch(texts, 0, **args)
    finally:
        CallLog.drop = staticmethod(drop)
    assert len(os.listdir(calls)) == 6
    import shutil
    shutil.rmtree(f"{store}/answers")  # as if the job had died before its commit
    incremental.code_batch(texts, 0, **args)
    incremental.code_batch(texts, 0, **args)  # a replay of a finished batch
    assert len(os.listdir(calls)) == 6 and incremental.stored_responses(spark, store).filter("error IS NULL").count() == 6


def test_the_streamed_table_may_be_a_folder_of_parts(spark, tmp_path):
    """One file or a folder of part files: the same rows (texts 3 and 7 lack a description or a title)."""
    from coderail.plans import catalog
    docs = spark.createDataFrame([(i, f"t{i}\n" + "x" * i, "de", "s", i) for i in range(1, 8)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = {}
    for kind in ("file", "folder"):
        sf = tmp_path / kind
        docs.repartition(1 if kind == "file" else 3).write.parquet(str(sf / ("part" if kind == "file" else "documents.parquet")))
        if kind == "file":
            (part,) = (sf / "part").glob("*.parquet")
            part.rename(sf / "documents.parquet")
        got[kind] = sorted(map(tuple, catalog.QUERIES["stream_classify"][0](spark, str(sf)).collect()))
    assert len(got["file"]) == 15 and got["folder"] == got["file"]
