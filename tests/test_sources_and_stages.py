"""Reading, ids, progress and the stages one by one."""

import pytest
from pyspark.sql import functions as F

from feedback_loom import CallableBackend, OfflineBackend, analyze, catalog, plans, texts_from
from feedback_loom.operators import rollup
from feedback_loom.functions.tokens import with_tokens
from feedback_loom.sources import read_stop_words, read_texts_csv, split_texts_csv, texts as text_sources


def test_csv_needs_no_split_at_commas(spark, tmp_path):
    (tmp_path / "a.csv").write_text('content\n"bad, slow and ""rude"""\nplain\n', encoding="utf-8")
    got = read_texts_csv(spark, str(tmp_path / "a.csv"))
    assert [r.content for r in got.collect()] == ['bad, slow and "rude"', "plain"]
    (tmp_path / "b.csv").write_text("content\nbad, slow\n", encoding="utf-8")
    assert [r.content for r in read_texts_csv(spark, str(tmp_path / "b.csv"), sep="\t").collect()] == ["bad, slow"]


def test_stop_words_are_trimmed_and_cleaned(spark, tmp_path):
    (tmp_path / "stop.txt").write_text(',0\n0,"\n"\n The\nthe\n不\n7\n', encoding="utf-8")
    assert sorted(r.term for r in read_stop_words(spark, str(tmp_path / "stop.txt")).collect()) == ["the", "不"]


def test_generated_ids_stay_the_same(spark):
    texts = texts_from(spark.range(100).select(F.concat(F.lit("t"), "id").alias("note")).repartition(5), "note")
    first = {r.row_id: r.content for r in texts.collect()}
    assert len(first) == 100 and {r.row_id: r.content for r in texts.repartition(3).collect()} == first


def test_rows_are_spread_only_on_demand(spark, folder):
    source = spark.read.parquet(f"{folder}/documents.parquet")
    assert texts_from(source, "text", "doc_id", 8).rdd.getNumPartitions() == 8
    plan = texts_from(source, "text", "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_word_work_gets_more_tasks_the_more_text_there_is(spark, tmp_path, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    rows = [(i, "Wort " * 200) for i in range(100)] + [(None, None), (7, "Wort")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert catalog.wide_documents(spark, str(tmp_path)).rdd.getNumPartitions() == cores
    monkeypatch.setattr(text_sources, "TEXT_BYTES", 1000)
    assert catalog.wide_documents(spark, str(tmp_path)).rdd.getNumPartitions() == max(cores, 101)
    counts = {r.row_id: r.n for r in catalog.words_per_text(spark, str(tmp_path)).collect()}
    assert counts == {i: 200 + (i == 7) for i in range(100)}


def test_progress_is_seen_while_another_action_runs(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, None)], "row_id int, score int")
    watched, seen = rollup.observed_progress(df, "score")
    watched.write.format("noop").mode("overwrite").save()
    assert seen.get == {"total": 3, "pending": 2}


def test_stages_one_by_one(spark, folder):
    backend = OfflineBackend(catalog.lexicon(spark, folder))
    scored = plans.SentimentScorer(backend).batch_run(catalog.documents(spark, folder))
    assert scored.filter("score IS NULL").count() == 0
    negatives = scored.filter("score <= 3")
    describer = plans.ClusterDescriber(backend)
    summary = describer.batch_run(negatives, max_clusters=4, score_col="score")
    assert summary.filter("issues IS NULL OR score > 3").count() == 0
    assigner = plans.LabelAssigner(backend, describer.clustering)
    assert assigner.propose(summary).status == "ok"
    classified = assigner.batch_run()
    classes = plans.CauseSummarizer(backend, describer.clustering).batch_run(classified, score_col="score")
    assert classes.agg(F.sum("count")).first()[0] == negatives.count()
    text = plans.ConclusionWriter(backend).batch_run(classes).first()[0]
    assert len(text.split("\n")) >= classes.count() and text.startswith("1. ")


def test_bad_csv_lines_are_set_apart(spark, tmp_path):
    (tmp_path / "a.csv").write_text('row_id,content\n1,good\nx,bad id\n2,fine\n3,too,many\n', encoding="utf-8")
    good, bad = split_texts_csv(spark, str(tmp_path / "a.csv"), "row_id LONG, content STRING")
    assert sorted(map(tuple, good.collect())) == [(1, "good"), (2, "fine")] and good.count() == 2
    assert sorted(r.line for r in bad.collect()) == ["3,too,many", "x,bad id"]


def test_stop_words_of_a_file_reach_the_tokeniser(spark, tmp_path):
    (tmp_path / "stop.txt").write_text("The\nroom\n", encoding="utf-8")
    texts = spark.createDataFrame([(1, "The room was bad")], "row_id long, content string")
    words = read_stop_words(spark, str(tmp_path / "stop.txt"))
    assert with_tokens(texts, stop_words=words).first().tokens == ["was", "bad"]


def test_results_can_drop_their_tables(spark):
    texts = spark.createDataFrame([(i, ("bad room " if i % 2 else "slow staff ") * (i % 3 + 1)) for i in range(12)],
                                  "row_id long, content string")
    def reply(instruction, prompts):
        return ["<sep>".join("1" for _ in p.split("<sep>")) for p in prompts]

    found = analyze(texts, CallableBackend(reply), max_clusters=2, stop_words=spark.createDataFrame([("slow",)], "term string"))
    assert found.classified.count() == 12 and "slow" not in {w for r in found.classified.collect() for w in r.tokens}
    assert found.paths
    found.drop_tables(spark)
    with pytest.raises(Exception):
        found.scored.count()
