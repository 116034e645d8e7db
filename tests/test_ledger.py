"""Runs that are cut off, calls that raise, and equal texts."""

import os
import random

import pytest
from compare import difference, duck
from pyspark.sql import functions as F

import oracles
from feedback_loom import CallableBackend, catalog
from feedback_loom.operators import protocol
from feedback_loom.operators.ledger import RunLedger
from feedback_loom.session import scratch_root


@pytest.fixture
def texts(spark):
    """A third of the rows hold one text; texts ending in 7 never get a valid score."""
    return spark.range(600).select(
        "id", F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, "the same").otherwise(F.concat(F.lit("text "), F.col("id").cast("string"))).alias("content"))


def recorder(folder, fail=lambda prompt: False):
    """A model that writes every answered prompt to a file of its own; a call with a failing prompt raises."""
    bare = catalog.note_remover()

    def reply(instruction, prompts):
        import os
        import uuid

        if any(fail(p) for p in prompts):
            raise ConnectionError("no line")
        for prompt in prompts:
            with open(os.path.join(folder, uuid.uuid4().hex), "w") as file:
                file.write(prompt)
        return ["<sep>".join("n/a" if t.endswith("7") else str(len(t) % 11) for t in bare(p).split("<sep>")) for p in prompts]

    return reply


def asked(folder):
    return [open(os.path.join(folder, name)).read() for name in os.listdir(folder)]


def scores(answered):
    return {r.row_id: r.score for r in answered.rows.collect()}


def test_a_run_goes_on_after_a_crash_and_asks_nothing_twice(spark, texts, tmp_path):
    plain = scores(CallableBackend(recorder(tmp_path)).score(texts, "content", "score", 30))
    once = sorted(asked(tmp_path))
    assert len(set(once)) == len(once)
    folder = tmp_path / "run"
    folder.mkdir()
    three = protocol.NOTES["format"]
    # the third round (batches of 7) never gets an answer
    broken = recorder(folder, lambda p: p.startswith(three) and p.count("<sep>") - three.count("<sep>") < 7)
    with pytest.raises(RuntimeError, match="no line"):
        CallableBackend(broken, run="crash").score(texts, "content", "score", 30)
    ledger = RunLedger(spark, "crash")
    assert {(r.step, r.round) for r in ledger.manifest().collect()} == {("score", 0), ("score", 1)}
    before = len(asked(folder))
    assert 0 < before < len(once)
    again = CallableBackend(recorder(folder), run="crash").score(texts, "content", "score", 30)
    assert scores(again) == plain and sorted(asked(folder)) == once
    assert {r.status for r in again.quarantine.collect()} == {"format"}
    # a third start reads everything from the files
    assert scores(CallableBackend(broken, run="crash").score(texts, "content", "score", 30)) == plain
    stored = RunLedger(spark, "crash").answers()
    assert stored.count() == stored.select("key").distinct().count() == len(once)
    with pytest.raises(ValueError, match="other texts"):
        CallableBackend(recorder(folder), run="crash").score(texts.limit(30), "content", "score", 30)
    ledger.drop()
    assert RunLedger(spark, "crash").manifest().count() == 0


def test_answers_of_a_round_that_was_cut_off_are_kept(spark, texts, tmp_path):
    plain = CallableBackend(recorder(tmp_path / ".."), run=None)
    wanted = scores(plain.score(texts, "content", "score", 4))
    # one prompt fails for ever: the others of its round are on file, though the round is not in the manifest
    broken = recorder(tmp_path, lambda p: "text 100<" in p or p.endswith("text 100"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        with pytest.raises(RuntimeError, match="no line"):
            CallableBackend(broken, run="cut").score(texts, "content", "score", 4)
        assert RunLedger(spark, "cut").manifest().count() == 0 and RunLedger(spark, "cut").answers().count() > 50
        assert scores(CallableBackend(recorder(tmp_path), run="cut").score(texts, "content", "score", 4)) == wanted
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    prompts = asked(tmp_path)
    assert len(prompts) == len(set(prompts)) == RunLedger(spark, "cut").answers().select("key").distinct().count()


def test_calls_that_raise_once_per_task_cost_no_other_call(spark, texts, tmp_path):
    marks, folder = tmp_path / "marks", tmp_path / "asked"
    marks.mkdir()
    folder.mkdir()
    record = recorder(folder)

    def fails_once(instruction, prompts):
        import os

        from pyspark import TaskContext

        mark = os.path.join(marks, str(TaskContext.get().partitionId()))
        if not os.path.exists(mark):
            open(mark, "w").close()
            raise TimeoutError("first call of the task")
        return record(instruction, prompts)

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        got = scores(CallableBackend(fails_once).score(texts, "content", "score", 4))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    prompts = asked(folder)
    assert len(os.listdir(marks)) > 1 and len(prompts) == len(set(prompts))
    assert got == scores(CallableBackend(record).score(texts, "content", "score", 4))


@pytest.mark.parametrize("hot", [10, 10_000])
def test_equal_texts_are_asked_once(texts, tmp_path, monkeypatch, hot):
    monkeypatch.setattr(protocol, "HOT_TEXT", hot)
    bare = catalog.note_remover()
    rows = texts.unionByName(texts.withColumn("row_id", F.col("row_id") + 1000)).repartition(5)
    answered = CallableBackend(recorder(tmp_path)).score(rows, "content", "score", 30)
    got = scores(answered)
    contents = {r.row_id: r.content for r in rows.collect()}
    assert got == {i: None if t.endswith("7") else len(t) % 11 for i, t in contents.items()}
    assert {r.row_id for r in answered.quarantine.collect()} == {i for i, t in contents.items() if t.endswith("7")}
    first = [p for p in asked(tmp_path) if bare(p) == p]
    assert sorted(t for p in first for t in p.split("<sep>")) == sorted(set(contents.values()))


def test_answers_of_a_hot_text_are_broadcast(spark, texts, monkeypatch):
    monkeypatch.setattr(protocol, "HOT_TEXT", 10)
    rows = texts.withColumn("__text", F.unhex(F.md5("content")))
    answers = protocol.distinct_texts(rows, "content", "row_id").drop("content", "row_id").withColumn("value", F.lit(1))
    found = protocol.spread(rows, answers, 600, "left")
    assert found.count() == 600 and found.where("value = 1").count() == 600
    assert "BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()


def files_below(folder):
    return [os.path.join(at, name) for at, _, names in os.walk(folder.removeprefix("file:")) for name in names]


@pytest.mark.parametrize("per_block", [250_000, 100])
def test_texts_are_stored_once_and_not_with_the_answers(spark, tmp_path, monkeypatch, per_block):
    monkeypatch.setattr(protocol, "TEXTS_PER_BLOCK", per_block)
    rng = random.Random(1)
    bodies = {i: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=12_000)) + str(i) for i in range(300)}
    rows = spark.createDataFrame([(i, t) for i, t in bodies.items()] + [(None, bodies[7]), (5, bodies[5]), (None, None)],
                                 "row_id long, content string").repartition(4)
    size = sum(map(len, bodies.values()))
    before = set(files_below(scratch_root(spark)))
    broken = recorder(tmp_path, lambda p: p.startswith(protocol.NOTES["format"]))
    with pytest.raises(RuntimeError, match="no line"):
        CallableBackend(broken, run=f"sizes{per_block}").score(rows, "content", "score", 30)
    # nothing of the round without an answer, and no texts, are left
    new = set(files_below(scratch_root(spark))) - before
    assert new and not any("/answers/score/1/" in path or "_texts/" in path for path in new)
    assert sum(map(os.path.getsize, new)) < size / 10
    answered = CallableBackend(recorder(tmp_path), run=f"sizes{per_block}").score(rows, "content", "score", 30)
    got = sorted(((-1 if r.row_id is None else r.row_id, r.content or "", r.score) for r in answered.rows.collect()), key=lambda r: r[:2])
    assert got == sorted([(i, t, None if t.endswith("7") else len(t) % 11) for i, t in [*bodies.items(), (-1, bodies[7]), (5, bodies[5])]] + [(-1, "", None)],
                         key=lambda r: r[:2])
    assert {r.content for r in answered.quarantine.collect()} == {t for t in bodies.values() if t.endswith("7")} | {None}
    new = set(files_below(scratch_root(spark))) - before
    assert not any("_texts/" in path for path in new) and sum(map(os.path.getsize, new)) < size / 10
    RunLedger(spark, f"sizes{per_block}").drop()


def test_names_of_runs(spark):
    for name in ("", "../x", "a/b", ".hidden"):
        with pytest.raises(ValueError):
            RunLedger(spark, name)


@pytest.mark.parametrize("name", ["resumed_run", "equal_texts", "run_rounds"])
def test_queries_of_runs_equal_sql(spark, folder, name):
    got = catalog.QUERIES[name](spark, folder).toPandas()
    assert difference(got, duck(folder).execute(oracles.oracle_sql()[name]).df()) is None
