"""One batch coding run, end to end, with the paid step materialised call by call.

texts -> prepare (written once per run) -> tasks x selected categories (keys, simplified names) -> requests (template,
messages; one hash over all that is sent) -> pairs (written once per run) -> skip requests whose answer is stored ->
classify the rest in waves of texts, each wave added to the answer store -> validate -> coded (written
once) -> wide results (written as a run), metrics, agreement with human codes.

Everything below a run's id can be made again and is overwritten when the run is started again; paid answers are not
below it. They go to the answer store (:class:`coderail.sources.answers.AnswerStore`), which is only ever added to,
and, until a wave is committed, to the call log, answer by answer. So neither lazy re-evaluation, nor a second run,
nor a run that follows a killed one under the same or another id, nor a Spark task that is tried again calls the model again
for a (request, model, temperature) that was answered. Failed pairs are stored with their error and retried by
the next run, as the reference retries on every run. One run at a time works on a ``base``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import infer, joins, prep, prompt, results, validate
from ..sources import results_io
from ..sources.answers import AnswerStore, CallLog, with_request_id


def requests(texts: DataFrame, selected: DataFrame, scheme: DataFrame, template: str, model: str,
             temperature: float) -> DataFrame:
    """Tasks with everything that is sent for them, and its hash."""
    t = prompt.with_request(prompt.construct_prompt(joins.build_tasks(texts, selected, scheme), template=template))
    return t.withColumn("model", F.lit(model)).withColumn("temperature", F.lit(float(temperature)))


def coding_run(spark: SparkSession, entries_raw: DataFrame, selected: DataFrame, scheme: DataFrame,
               infer_fn: Callable[[dict], str], base: str, categories: Sequence[str], model: str = "rule-scorer",
               temperature: float = 0.0, run_id: str | None = None, num_partitions: int | None = None,
               backoff: float = infer.FIRST_BACKOFF_S, template: str = prompt.PROMPT_TEMPLATE,
               human_codes: DataFrame | None = None, on_invalid: str = "default", waves: int = 1,
               store_buckets: int | None = None, call_log: bool = True) -> dict[str, DataFrame]:
    """Runs the coding of ``entries_raw`` and returns ``coded``, ``wide``, ``metrics`` (DataFrames over stored
    data), ``new_answers`` (rows that runs of this id added to the store), ``outcomes`` (an Observation with answers per
    validation outcome) and, with ``human_codes`` (wide, as read), ``agreement`` (kappa per category).

    ``waves``: commits of the paid step; a text's wave is a hash of its ordinal. On object stores the call log holds one file per
    call of a wave, so very many calls want more waves there. ``store_buckets``: buckets of a store
    that this run creates (default: the session's shuffle partitions). ``call_log=False``: without the log, for shared folders that Python workers cannot reach;
    then a killed wave, or a task that is tried again, pays again for its own calls.
    """
    base = base.rstrip("/")
    rid = run_id or results_io.new_run_id()

    def written(df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
        path = f"{base}/{name}/run_id={rid}"
        df.write.mode("overwrite").partitionBy(*by).parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    store, logs = AnswerStore(spark, f"{base}/responses", store_buckets), f"{base}/call_log"
    if call_log:
        store.absorb(logs, rid)
    # Texts are de-duplicated (a shuffle of every text) once, requests hashed once: later steps read
    # the small table of pairs.
    entries = written(prep.prepare_entries(entries_raw), "entries")
    tasks = requests(entries, selected, scheme, template, model, temperature)
    pairs = written(with_request_id(tasks).select("ordinal", "cat_ordinal", "category", "title", "request_id"), "pairs")
    # The pending categories of each text (bounded by the selection) are joined to the texts once; every wave
    # then reads its own folder and builds the requests of those pairs only.
    pending = store.without_answer(pairs).groupBy("ordinal").agg(F.collect_set("category").alias("_pending"))
    wave = F.pmod(F.xxhash64("ordinal"), F.lit(waves)).cast("int")
    todo = written(entries.join(pending, "ordinal").withColumn("_wave", wave), "pending", by=["_wave"])
    for w in sorted(r["_wave"] for r in todo.select("_wave").distinct().collect()):
        texts = todo.where(F.col("_wave") == w).drop("_wave")
        if num_partitions:  # texts are dealt out, not the requests, each of which repeats its text
            texts = texts.repartition(num_partitions)
        mine = (requests(texts, selected, scheme, template, model, temperature)
                .filter(F.array_contains(F.col("_pending"), F.col("category"))))
        log = f"{logs}/{rid}/{uuid.uuid4().hex}" if call_log else None
        store.add(infer.classify(mine.drop("model", "temperature"), infer_fn, model=model, temperature=temperature,
                                 backoff=backoff, call_log=log), rid)
        if log:
            CallLog.drop(log)
    outcomes = Observation(f"coding_run_{rid}")
    answered = pairs.join(store.answered(), "request_id")
    valid = validate.validate_responses(answered, "response", observation=outcomes, on_invalid=on_invalid)
    coded = written(valid.select("ordinal", "cat_ordinal", "title", "category", "ai_code", "confidence",
                                 "confidence_level", "reasoning", "outcome"), "coded")
    results_io.write_results(results.wide_results(coded, categories, entries=entries), f"{base}/results", rid)
    out = {"coded": coded.join(entries.select("ordinal", "description"), "ordinal"),
           "wide": results_io.read_results(spark, f"{base}/results", rid), "metrics": results.category_metrics(coded),
           "new_answers": store.table().filter(F.col("run_id") == rid), "outcomes": outcomes}
    if human_codes is not None:
        merged = joins.merge_codes(entries, prep.prepare_codes_wide(human_codes).drop("ordinal"))
        human = joins.codes_long(merged, categories)
        out["agreement"] = results.agreement_kappa(results.paired_codes(coded, human))
    return out
