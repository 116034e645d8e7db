"""States that add up, streams, and results that are stored all or none."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from feedback_loom.functions import answers as A, columns as C
from feedback_loom.functions.tokens import with_tokens
from feedback_loom.operators import rollup, state
from feedback_loom.sources import load_results, save_results
from feedback_loom.sources.texts import RESULT_TABLES

ROWS = [(1, "a", 3, "bad bad room"), (2, "a", None, "room"), (3, None, 5, ""), (4, "b", None, None), (5, "a", 4, "slow bad"),
        (5, "a", 4, "slow bad")]
SCHEMA = "row_id long, class string, score int, content string"


def listed(frame, order):
    return [tuple(r) for r in frame.orderBy(order).collect()]


def test_states_of_parts_add_up(spark, tmp_path):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    kept = state.StateTable(spark, str(tmp_path / "s"))
    assert kept.read() is None
    for number in (0, 1, 1, 2, 3):  # a batch that is run again counts once; the last is empty
        kept.add(state.group_state(rows.filter(F.col("row_id") % 3 == number), "class", "score"), number)
        if number == 1:
            kept.fold()
    want = listed(rollup.group_shares(rows, "class", "score"), "class")
    assert listed(state.shares(kept.read(), "class"), "class") == want
    kept.fold()
    kept.add(state.group_state(rows, "class", "score"), 3)  # folded already
    assert listed(state.shares(kept.read(), "class"), "class") == want
    kept.drop_folded()
    assert listed(state.shares(kept.read(), "class"), "class") == want
    assert [p.name for p in (tmp_path / "s").iterdir()] == ["fold-3"]


def test_a_part_that_was_cut_off_counts_for_nothing(spark, tmp_path):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    kept = state.StateTable(spark, str(tmp_path / "s"))
    kept.add(state.group_state(rows, "class", "score"), 0)
    kept.add(state.group_state(rows, "class", "score"), 1)
    (tmp_path / "s" / "batch-1" / "_SUCCESS").unlink()
    assert listed(state.shares(kept.read(), "class"), "class") == listed(rollup.group_shares(rows, "class", "score"), "class")


def test_a_stream_keeps_the_state(spark, tmp_path):
    rows = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    rows.write.parquet(str(tmp_path / "in"))
    kept = state.StateTable(spark, str(tmp_path / "terms"))
    stream = with_tokens(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")))
    query = (stream.writeStream.foreachBatch(kept.sink(state.term_state)).option("checkpointLocation", str(tmp_path / "c"))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    assert listed(kept.read(), "term") == listed(state.term_state(with_tokens(rows)), "term")
    assert len(list((tmp_path / "terms").glob("batch-*"))) > 1


def test_expressions_on_a_stream_equal_those_on_a_table(spark, tmp_path):
    answers = ["3<sep>9", "<sep>1.a<sep>2.b<sep>", "11", None, "", f"{A.ISSUES_HEADING}{A.HEADING_COLON}1.x<sep1>{A.REASONS_HEADING}{A.HEADING_COLON}1.y",
               "y", "n<sep>merge a and b", "junk"]
    spark.createDataFrame(list(enumerate(answers)), "score int, answer string").write.parquet(str(tmp_path / "in"))

    def applied(df):
        answer = F.col("answer")
        return df.filter(C.is_negative(F.col("score"), 7)).select(
            "score", A.strip_outer(answer).alias("bare"), A.split_items(answer).alias("items"), A.item_count(answer).alias("n"),
            A.score_list_status(answer, F.lit(2)).alias("status"), A.issue_list_status(answer).alias("issue_status"),
            A.issues_of(answer).alias("issues"), A.paired_reasons_of(answer).alias("reasons"), A.reasons_of(answer).alias("causes"),
            A.numbered_labels(answer).alias("labels"), A.is_numbered_list(answer).alias("is_list"),
            A.review_decision(answer).alias("decision"), A.review_hint(answer).alias("hint"))

    stream = applied(spark.readStream.schema("score int, answer string").parquet(str(tmp_path / "in")))
    query = stream.writeStream.format("memory").queryName("applied").trigger(availableNow=True).start()
    query.awaitTermination()
    want = listed(applied(spark.read.parquet(str(tmp_path / "in"))), "score")
    assert len(want) == 8 and listed(spark.table("applied"), "score") == want


def results(spark, broken=None):
    tables = {name: spark.range(i + 1).withColumn("name", F.lit(name)) for i, name in enumerate(RESULT_TABLES)}
    if broken:
        tables[broken] = tables[broken].withColumn("name", F.raise_error(F.lit("lost")).cast("string"))
    return SimpleNamespace(**tables)


def test_results_are_stored_all_or_none(spark, tmp_path):
    path = str(tmp_path / "out")
    with pytest.raises(Exception, match="lost"):
        save_results(results(spark, RESULT_TABLES[2]), path)
    with pytest.raises(FileNotFoundError):
        load_results(spark, path)
    assert not list((tmp_path / "out").glob("attempt-*"))
    save_results(results(spark), path)
    assert {name: t.count() for name, t in load_results(spark, path).items()} == {n: i + 1 for i, n in enumerate(RESULT_TABLES)}
    with pytest.raises(FileExistsError):
        save_results(results(spark), path)
    assert len(list((tmp_path / "out").glob("attempt-*"))) == 1


def test_a_marker_that_was_cut_off_commits_nothing(spark, tmp_path):
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "COMMITTED").write_text("attempt-12")
    with pytest.raises(FileNotFoundError):
        load_results(spark, str(tmp_path / "out"))


def test_ranks_of_ties_and_many_classes(spark):
    rows = spark.range(3000).select(F.format_string("c%05d", "id").alias("class"), (F.col("id") % 7 / 7).alias("percentage"))
    got = [(r["rank"], r["class"]) for r in rollup.ranked_by_share(rows).orderBy("rank").collect()]
    want = sorted(rows.collect(), key=lambda r: (-r.percentage, r["class"]))
    assert got == [(i + 1, r["class"]) for i, r in enumerate(want)]
    assert rollup.ranked_by_share(rows.limit(0)).count() == 0
