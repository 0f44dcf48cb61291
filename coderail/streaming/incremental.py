"""Incremental coding of arriving texts, at a cost that follows the batch and not what came before it.

``readStream`` of an entry folder -> strip, drop missing -> first title wins, by keyed state (``transformWithState``: one
row per title, kept in RocksDB and looked up for the titles of the batch only) -> per micro-batch
(``foreachBatch``): pairs to code -> requests -> classify -> answers.

Only an answered (text, category) pair is done.  Instead of comparing all texts and categories with all answers, every batch
leaves two tables for the next one:

* ``covered``: the last batch in which each category was selected.  A category that is selected now opens the texts
  of the batches since; in ordinary operation these are the new texts alone, and a category that is new or was left out
  for a while reads just the batches that it missed.
* ``open``: pairs that were opened and have no answer, with their texts: failed calls, and failures of a category
  that is not selected for now.  They are asked again with the next batch that selects their category.

Exactly once by construction: every table of batch ``b`` is a folder ``batch_id=b`` written with ``overwrite``, made from tables
of earlier batches and from the paid answers of its own, which are only ever added to (``answers``), call by call
(``call_log``).  A replayed batch, after a failure of driver or executors, therefore changes nothing and pays for
nothing twice.  Tables live below the shared folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators import infer, joins, prep, prompt
from ..plans.run import requests
from ..sources.answers import KEYS, CallLog, read_store, with_request_id

TEXT = ["ordinal", "title", "description"]
PAIR = ["title", "category"]
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def first_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The first row of each title of an Arrow batch, so that a title that holds many rows reaches its state as a few."""
    for pdf in frames:
        yield pdf.loc[pdf.groupby("title", sort=False)["ordinal"].idxmin()]


class FirstTitle(StatefulProcessor):
    """Passes the first row (least ordinal) of a title that has not come before."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "ordinal long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best = None
        for pdf in rows:
            row = pdf.loc[[pdf["ordinal"].idxmin()]]
            if best is None or row["ordinal"].iloc[0] < best["ordinal"].iloc[0]:
                best = row
        if best is not None and not self.seen.exists():
            self.seen.update((int(best["ordinal"].iloc[0]),))
            yield best[["title", "ordinal", "description"]]

    def close(self) -> None:
        pass


def new_texts(texts: DataFrame) -> DataFrame:
    """Streaming: prepared texts whose title has not come before."""
    out = prep.trim_columns(prep.drop_missing(texts.select(*TEXT), ["title", "description"]), ["title", "description"])
    schema = "ordinal long, title string, description string"
    out = out.select(F.col("ordinal").cast("long").alias("ordinal"), "title", "description").mapInPandas(first_rows, schema)
    return out.groupBy("title").transformWithStateInPandas(
        FirstTitle(), outputStructType="title string, ordinal long, description string", outputMode="append", timeMode="none").select(*TEXT)


def _before(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """The table that the batch before this one left (read by its own path: no listing of all batches)."""
    if batch_id > 0:
        try:
            return spark.read.parquet(f"{path}/batch_id={batch_id - 1}")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
    every = read_store(spark, path)  # a store whose batch ids have gaps
    last = None if every is None else every.where(F.col("batch_id") < batch_id).agg(F.max("batch_id")).first()[0]
    return None if last is None else spark.read.parquet(f"{path}/batch_id={last}")


def code_batch(batch: DataFrame, batch_id: int, *, selected: DataFrame, scheme: DataFrame,
               infer_fn: Callable[[dict], str], store: str, model: str, temperature: float,
               num_partitions: int | None = None, template: str = prompt.PROMPT_TEMPLATE,
               backoff: float = infer.FIRST_BACKOFF_S, known_titles_left: bool = True, call_log: bool = True) -> None:
    """One micro-batch of the incremental run (see module docstring).

    ``known_titles_left``: ``batch`` is raw and may repeat titles of earlier batches, which are looked up in the stored texts;
    the stream itself sends new texts only.  ``call_log`` as in :func:`coderail.plans.run.coding_run`.
    """
    spark = batch.sparkSession

    def written(df: DataFrame, name: str) -> DataFrame:
        path = f"{store}/{name}/batch_id={batch_id}"
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    if known_titles_left:
        batch = prep.prepare_entries(batch)
        earlier = read_store(spark, f"{store}/entries")
        if earlier is not None:
            batch = batch.join(earlier.where(F.col("batch_id") < batch_id).select("title"), "title", "left_anti")
    entries = written(batch.select(*TEXT), "entries")
    picked = joins.selected_categories(selected, scheme).select("key").distinct().collect()  # a user's menu choice
    now = sorted(r["key"] for r in picked)

    covered = _before(spark, f"{store}/covered", batch_id)
    upto = {r["category"]: r["upto"] for r in covered.collect()} if covered is not None else {}  # a row per category
    asked = F.array(*[F.lit(c) for c in now]).cast("array<string>")
    opened = entries.select(*TEXT, F.explode(asked).alias("category"))
    missed = {c: upto.get(c, -1) + 1 for c in now if upto.get(c, -1) < batch_id - 1}
    if missed:
        older = read_store(spark, f"{store}/entries")
        since = F.create_map(*[F.lit(x) for pair in missed.items() for x in pair])
        older = older.where((F.col("batch_id") >= min(missed.values())) & (F.col("batch_id") < batch_id))  # only these folders
        late = F.filter(F.array(*[F.lit(c) for c in missed]), lambda c: since[c] <= F.col("batch_id"))
        opened = opened.unionByName(older.select(*TEXT, F.explode(late).alias("category")))
    left = _before(spark, f"{store}/open", batch_id)
    if left is not None:
        opened = opened.unionByName(left)
    opened = written(opened, "opened")
    todo = opened.where(F.col("category").isin(now)) if now else opened.limit(0)

    per_text = todo.groupBy(*TEXT).agg(F.collect_set("category").alias("_pending"))
    if num_partitions:  # texts are dealt out, not the requests, each of which repeats its text
        per_text = per_text.repartition(num_partitions)
    tasks = with_request_id(requests(per_text, selected, scheme, template, model, temperature)
                            .where(F.array_contains("_pending", F.col("category"))).drop("_pending"))
    pairs = written(tasks.select("ordinal", "cat_ordinal", "category", "title", *KEYS, "request_id"), "pairs")
    paid_path, log = f"{store}/answers/batch_id={batch_id}", f"{store}/call_log/batch_id={batch_id}"
    if call_log:  # what a killed attempt at this batch has paid for
        found = CallLog.left(spark, log)
        if found is not None:
            with_request_id(found).withColumn("error", F.lit(None).cast("string")).select(
                "request_id", "attempts", "response", "error").write.mode("append").parquet(paid_path)
            CallLog.drop(log)
    paid = read_store(spark, paid_path)
    if paid is not None:
        tasks = tasks.join(paid.where(F.col("error").isNull()).select("request_id"), "request_id", "left_anti")
    answers = infer.classify(tasks.drop("model", "temperature"), infer_fn, model=model, temperature=temperature, backoff=backoff,
                             call_log=f"{log}/{uuid.uuid4().hex}" if call_log else None)
    answers.select("request_id", "attempts", "response", "error").write.mode("append").parquet(paid_path)
    if call_log:
        CallLog.drop(log)

    best = read_store(spark, paid_path).groupBy("request_id").agg(
        F.min("response").alias("response"), F.max("error").alias("_error"), F.max("attempts").alias("attempts"))
    done = pairs.join(best, "request_id").withColumn("error", F.when(F.col("response").isNull(), F.col("_error")))
    done = written(done.select("ordinal", "cat_ordinal", "category", "title", *KEYS, "attempts", "response", "error"), "responses")
    written(opened.join(done.where(F.col("error").isNull()).select(*PAIR), PAIR, "left_anti").select(*TEXT, "category"), "open")
    written(spark.createDataFrame([*{**upto, **{c: batch_id for c in now}}.items()], "category string, upto long").coalesce(1), "covered")


def start(spark: SparkSession, source: str, *, schema: str, selected: DataFrame, scheme: DataFrame,
          infer_fn: Callable[[dict], str], store: str, checkpoint: str, fmt: str = "parquet",
          path_glob: str | None = None, model: str = "rule-scorer", temperature: float = 0.0,
          available_now: bool = True, max_files_per_trigger: int | None = None,
          transform: Callable[[DataFrame], DataFrame] | None = None, num_partitions: int | None = None,
          template: str = prompt.PROMPT_TEMPLATE, backoff: float = infer.FIRST_BACKOFF_S, call_log: bool = True):
    """Starts the incremental run; returns the ``StreamingQuery``. ``transform`` maps the source
    rows to entry columns (ordinal, title, description); it runs inside the streaming plan. The selection
    may change whenever the query is started again on its checkpoint. Sets the RocksDB state store for the session, which
    keyed state needs, where none is named."""
    if spark.conf.get(STATE_STORE, None) != ROCKSDB:
        spark.conf.set(STATE_STORE, ROCKSDB)
    rd = spark.readStream.schema(schema).format(fmt)
    if path_glob:
        rd = rd.option("pathGlobFilter", path_glob)
    if max_files_per_trigger:
        rd = rd.option("maxFilesPerTrigger", max_files_per_trigger)
    src = rd.load(source)
    if transform is not None:
        src = transform(src)

    def run(batch: DataFrame, batch_id: int) -> None:
        code_batch(batch, batch_id, selected=selected, scheme=scheme, infer_fn=infer_fn, store=store, model=model,
                   temperature=temperature, num_partitions=num_partitions, template=template, backoff=backoff,
                   known_titles_left=False, call_log=call_log)

    w = new_texts(src).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def stored_responses(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.parquet(f"{store}/responses")
