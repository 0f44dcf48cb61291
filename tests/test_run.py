"""A batch run materialises answers once; a second run over the same store calls nothing."""

from coderail.operators import infer
from coderail.plans import stages as P
from coderail.plans.fixtures import fixture
from coderail.plans.run import coding_run
from coderail.session import scratch_path
from core_helpers import SF_SMALL


def test_second_run_reuses_store(spark):
    base = scratch_path(spark, "test-run")
    args = (P.entries_raw(spark, SF_SMALL), fixture(spark, SF_SMALL, "selected"), P.task_scheme(spark, SF_SMALL))
    first = coding_run(spark, *args, infer.rule_scorer, base, P.CATEGORIES, run_id="20250101_000000")
    m1 = sorted(map(tuple, first["metrics"].collect()))
    n_tasks = P.tasks(spark, SF_SMALL).count()
    assert first["coded"].count() == n_tasks
    counts = first["outcomes"].get  # filled by the results write inside the run
    assert counts["answers"] == n_tasks and counts["ok"] == n_tasks
    store_rows = spark.read.parquet(f"{base}/responses").count()
    second = coding_run(spark, *args, infer.rule_scorer, base, P.CATEGORIES, run_id="20250101_000001")
    # every prompt already has a stored answer: nothing pending, nothing appended, nothing paid twice
    assert second["new_answers"].count() == 0
    assert spark.read.parquet(f"{base}/responses").count() == store_rows == n_tasks
    assert sorted(map(tuple, second["metrics"].collect())) == m1
    assert second["wide"].count() == first["wide"].count()


def test_rerun_calls_only_failed_pairs(spark):
    base = scratch_path(spark, "test-rerun")
    args = (P.entries_raw(spark, SF_SMALL), fixture(spark, SF_SMALL, "selected"), P.task_scheme(spark, SF_SMALL))
    first = coding_run(spark, *args, infer.flaky_scorer, base, P.CATEGORIES, run_id="20250101_000000",
                       num_partitions=4, backoff=0.0)   # no real waiting between attempts
    n_tasks = P.tasks(spark, SF_SMALL).count()
    stored = spark.read.parquet(f"{base}/responses")
    n_failed = stored.filter("error IS NOT NULL").count()
    assert 0 < n_failed < n_tasks and first["coded"].count() == n_tasks - n_failed
    second = coding_run(spark, *args, infer.rule_scorer, base, P.CATEGORIES, run_id="20250101_000001")
    new = second["new_answers"]
    assert new.count() == n_failed and new.filter("error IS NULL").count() == n_failed
    assert second["coded"].count() == n_tasks


def test_killed_run_pays_only_what_was_not_committed(spark):
    import pytest
    base = scratch_path(spark, "test-killed")
    args = (P.entries_raw(spark, SF_SMALL), fixture(spark, SF_SMALL, "selected"), P.task_scheme(spark, SF_SMALL))

    real, calls = infer.classify, []

    def classify(*a, **k):
        calls.append(1)
        if len(calls) > 3:
            raise RuntimeError("killed")
        return real(*a, **k)
    infer.classify = classify
    try:
        with pytest.raises(RuntimeError, match="killed"):
            coding_run(spark, *args, infer.rule_scorer, base, P.CATEGORIES, run_id="a", waves=5)
    finally:
        infer.classify = real
    paid = spark.read.parquet(f"{base}/responses").count()
    out = coding_run(spark, *args, infer.rule_scorer, base, P.CATEGORIES, run_id="b", waves=5)
    n_tasks = P.tasks(spark, SF_SMALL).count()
    assert 0 < paid < n_tasks and out["new_answers"].count() == n_tasks - paid and out["coded"].count() == n_tasks


def test_template_messages_agreement_and_invalid_answers(spark):
    base = scratch_path(spark, "test-options")
    texts = spark.createDataFrame([(i, f"t{i}", "d" * i) for i in range(6)], "ordinal long, title string, description string")
    codes = spark.createDataFrame([(i, f" t{i} ", str(i % 2)) for i in range(5)], "ordinal long, title string, human_code_quality string")
    pick = spark.createDataFrame([(1, "Textqualitaet")], "ordinal int, key string")

    def scorer(request):
        system, user = request["messages"]
        assert system["role"] == "system" and user["content"].startswith("T=" + request["title"]) and "reasoning" in user["content"]
        return '{"value": "%d", "confidence": 0.5, "reasoning": "r"}' % (len(request["description"]) % 2)
    out = coding_run(spark, texts, pick, P.task_scheme(spark, SF_SMALL), scorer, base, ["quality"], template="T=[title] [values]",
                     human_codes=codes, backoff=0.0)
    assert out["coded"].count() == 6 and out["new_answers"].filter("error IS NOT NULL").count() == 0
    row = out["agreement"].collect()[0]
    assert (row.category, row.n_pairs, row.observed) == ("quality", 6, round(5 / 6, 4))
    from coderail.operators.validate import validate_responses
    df = spark.createDataFrame([("nope",), ('{"value": "1", "confidence": 1, "reasoning": ""}',)], "response string")
    assert [r.ai_code for r in validate_responses(df, on_invalid="raw").collect()] == ["nope", "1"]
    assert [r.ai_code for r in validate_responses(df, on_invalid="drop").collect()] == ["1"]


def test_unreadable_store_is_not_an_empty_one(spark, tmp_path):
    import pytest

    from coderail.sources.answers import read_store
    assert read_store(spark, str(tmp_path / "none")) is None
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        read_store(spark, str(tmp_path / "bad"))


def test_same_id_again_keeps_the_store(spark):
    """Started again under its own id a run keeps what it paid for, whether it ended well, failed in part or was killed."""
    import pytest
    base = scratch_path(spark, "test-same-id")
    args = (P.entries_raw(spark, SF_SMALL), fixture(spark, SF_SMALL, "selected"), P.task_scheme(spark, SF_SMALL))
    n_tasks = P.tasks(spark, SF_SMALL).count()
    real, calls = infer.classify, []

    def classify(*a, **k):
        calls.append(1)
        if len(calls) > 2:
            raise RuntimeError("killed")
        return real(*a, **k)
    infer.classify = classify
    try:
        with pytest.raises(RuntimeError, match="killed"):
            coding_run(spark, *args, infer.flaky_scorer, base, P.CATEGORIES, run_id="r", waves=4, backoff=0.0)
    finally:
        infer.classify = real
    paid = spark.read.parquet(f"{base}/responses").filter("error IS NULL").count()
    assert 0 < paid < n_tasks
    for _ in range(3):
        out = coding_run(spark, *args, infer.rule_scorer, base, P.CATEGORIES, run_id="r", waves=4)
        stored = spark.read.parquet(f"{base}/responses").filter("error IS NULL")
        assert stored.count() == stored.select("prompt_hash").distinct().count() == n_tasks
        assert out["coded"].count() == n_tasks and out["wide"].count() == n_tasks // 3


def plan_of(df):
    import contextlib
    import io
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain()
    return out.getvalue()


def test_store_is_joined_in_its_buckets(spark, tmp_path):
    """Neither the search for pending pairs nor the join with the answers shuffles the store, in any session's name for it."""
    from coderail.sources.answers import AnswerStore, with_request_id
    rows = spark.range(500).selectExpr("sha2(string(id), 256) prompt_hash", "'m' model", "0.0D temperature", "1 attempts",
                                       "string(id) response", "if(id % 5 = 0, 'down', null) error")
    store = AnswerStore(spark, str(tmp_path / "s"), 6)
    store.add(rows, "a")
    store.add(rows.where("response % 2 = 0"), "b")
    assert AnswerStore(spark, str(tmp_path / "s"), 99).buckets == 6
    asked = spark.range(600).selectExpr("id", "sha2(string(id), 256) prompt_hash", "'m' model", "0.0D temperature")
    asked = with_request_id(asked)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df, n in ((store.without_answer(asked), 200), (asked.join(store.answered(), "request_id"), 400)):
            assert df.count() == n
            plan = plan_of(df)
            assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1, plan  # the other side's
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_call_log_of_a_dead_job_is_taken_in(spark, tmp_path):
    from coderail.sources.answers import KEYS, AnswerStore, CallLog
    store, log = AnswerStore(spark, str(tmp_path / "s"), 3), str(tmp_path / "log")
    store.absorb(log, "r")  # there is none
    first = CallLog(f"{log}/r/job", 4)
    first.record(("h1", "m", 0.0), "one", 2)
    first.record(("h2", "m", 0.0), "two\n{}", 1)
    assert CallLog(f"{log}/r/job", 4).known() == {("h1", "m", 0.0): ("one", 2, None), ("h2", "m", 0.0): ("two\n{}", 1, None)}
    assert CallLog(f"{log}/r/job", 5).known() == {}
    store.absorb(log, "r")
    store.absorb(log, "r")
    CallLog(f"{log}/r/later", 0).record(("h1", "m", 0.0), "one", 1)  # answered already
    store.absorb(log, "r")
    assert sorted(tuple(r[c] for c in KEYS) + (r["response"],) for r in store.table().collect()) == [("h1", "m", 0.0, "one"), ("h2", "m", 0.0, "two\n{}")]


def test_a_line_that_was_not_finished_does_not_count(spark, tmp_path):
    """The log of one attempt is one file; its writer may die within a line."""
    from coderail.sources.answers import CallLog
    log = CallLog(str(tmp_path / "log"), 0)
    for i in range(3):
        log.record((f"h{i}", "m", 0.0), f"a{i}", 1)
    (file,) = (tmp_path / "log" / "part-000000").iterdir()
    file.write_bytes(file.read_bytes()[:-9])
    want = {(f"h{i}", "m", 0.0): (f"a{i}", 1, None) for i in range(2)}
    assert CallLog(str(tmp_path / "log"), 0).known() == want
    assert sorted(r.response for r in CallLog.left(spark, str(tmp_path / "log")).collect()) == ["a0", "a1"]


KILLED = """
import os, sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
from coderail.operators import infer
calls = {calls!r}
def scorer(request):
    done = len(os.listdir(calls))
    if done == 7 and not os.path.exists(calls + ".died"):
        open(calls + ".died", "w").close()
        os._exit(1)  # the worker dies after seven paid calls
    open(os.path.join(calls, request["prompt"] + "-" + str(done)), "w").close()
    return '{{"value": "1"}}'
spark = SparkSession.builder.master("local[1,3]").config("spark.ui.enabled", "false").config("spark.default.parallelism", "1").getOrCreate()
df = spark.range(0, 12, 1, 1).selectExpr("string(id) prompt")
out = infer.classify(df, scorer, call_log={log!r} if {logged!r} else None)
print("ANSWERS", out.where("response is not null").count(), "CALLS", len(os.listdir(calls)))
"""


def test_a_task_that_dies_repeats_no_call(tmp_path):
    """A worker that is killed after seven calls: with the log the retried task makes the other five, without it all twelve."""
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for logged, calls in ((True, 12), (False, 19)):
        folder = tmp_path / f"calls-{logged}"
        folder.mkdir()
        code = KILLED.format(repo=repo, calls=str(folder), log=str(tmp_path / "log"), logged=logged)
        done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300,
                              env={**os.environ, "PYTHONPATH": repo})
        assert f"ANSWERS 12 CALLS {calls}" in done.stdout, done.stdout + done.stderr[-3000:]
