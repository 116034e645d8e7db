"""Joins by word beyond a broadcast: the same results in blocks, and no row moved by its word."""

import random

import pytest
from pyspark.sql import functions as F

from feedback_loom import session
from feedback_loom.backends import lexicon_scores
from feedback_loom.operators.clusters import nearest_centroid


@pytest.fixture
def plans(monkeypatch):
    """The plans of all tables that are written in the test."""
    seen, write = [], session.to_table

    def noted(df, *args):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, *args)

    monkeypatch.setattr(session, "to_table", noted)
    return seen


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_centroids_in_blocks(spark, plans):
    draw = random.Random(1)
    terms = [f"t{i}" for i in range(40)]
    # t0 is in every row and every centroid
    weights = spark.createDataFrame([(i, t, draw.choice([0.25, 0.5])) for i in range(60) for t in ["t0", *draw.sample(terms[1:], 5)]],
                                    "row_id long, term string, weight double").unionByName(
        spark.createDataFrame([(99, None, 1.0), (98, "strange", 1.0)], "row_id long, term string, weight double"))
    centroids = spark.createDataFrame([(k, t, 0.5) for k in range(30) for t in ["t0", *draw.sample(terms[1:], 4)]],
                                      "label_id int, term string, weight double")
    want = nearest_centroid(weights, centroids, "label_id", max_rows=1000).orderBy("row_id").collect()
    assert len(want) == 60
    assert nearest_centroid(weights, centroids, "label_id").orderBy("row_id").collect() == want
    plans.clear()
    got = nearest_centroid(weights, centroids, "label_id", max_bytes=600)
    assert got.orderBy("row_id").collect() == want
    rounds = [p for p in plans if "BroadcastHashJoin" in p]
    assert len(rounds) > 20
    assert not any("hashpartitioning(term" in p or "SortMergeJoin" in p for p in [*rounds, plan_of(got)])


def test_weighted_lexicon_in_blocks(spark, plans):
    draw = random.Random(2)
    words = [f"word{c}" for c in "abcdefghijklmnopqrstuvwxyz"]
    rows = [(i, " ".join(["wordz", *draw.choices(words, k=6)])) for i in range(80)] + [(80, None), (81, ""), (82, "strange")]
    texts = spark.createDataFrame(rows, "row_id long, content string")
    lexicon = spark.createDataFrame([(w, draw.choice([-2.0, -0.5, 0.5, 1.5])) for w in words], "term string, polarity double")
    want = lexicon_scores(texts, lexicon).orderBy("row_id").collect()
    plans.clear()
    got = lexicon_scores(texts, lexicon, max_bytes=200)
    assert got.orderBy("row_id").collect() == want and len(want) == 83
    assert sum("BroadcastHashJoin" in p for p in plans) > 4
    assert not any("hashpartitioning(term" in p for p in plans)


def test_empty_tables(spark):
    weights = spark.createDataFrame([(1, "a", 1.0)], "row_id long, term string, weight double")
    none = spark.createDataFrame([], "label_id int, term string, weight double")
    assert nearest_centroid(weights, none, "label_id").count() == 0
    assert nearest_centroid(weights.limit(0), none, "label_id", max_bytes=1).count() == 0
