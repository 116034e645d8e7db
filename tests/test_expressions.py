"""Answer parsing, scores, words: one case per rule."""

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from feedback_loom.functions import answers as A, columns as C
from feedback_loom.functions.tokens import with_tokens
from feedback_loom.operators import labels, rollup
from feedback_loom.operators.clusters import elbow_curve
from feedback_loom.sources import split_usable


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("answer, bare", [
    (" <sep>prices<sep>\n", "prices"),          # whole delimiters only, no letters lost
    ("pes<sep>spe", "pes<sep>spe"),
    ("<sep><sep>5<sep>6<sep><sep>", "5<sep>6"),
    ("   ", ""),
])
def test_strip_outer(spark, answer, bare):
    assert one(spark, answer, A.strip_outer) == bare


@pytest.mark.parametrize("answer, n, status", [
    ("1<sep>10<sep>0", 3, "ok"),
    (" <sep>1<sep>10<sep>0<sep>\n", 3, "ok"),
    ("1<sep>10", 3, "count"),
    ("1<sep>10<sep>0<sep>4", 3, "count"),
    ("1<sep>11<sep>0", 3, "format"),
    ("1<sep>7.5<sep>0", 3, "format"),
    ("1<sep> 7<sep>0", 3, "format"),
    ("", 1, "format"),
    (None, 1, "missing"),
])
def test_score_answers(spark, answer, n, status):
    assert one(spark, answer, lambda c: A.score_list_status(c, F.lit(n))) == status


@pytest.mark.parametrize("answer, status", [
    ("prices<sep>staff", "ok"), ("prices<sep>other", "label"), ("prices", "count"), (None, "missing"),
])
def test_label_answers(spark, answer, status):
    allowed = F.lit(["prices", "staff"])
    assert one(spark, answer, lambda c: A.label_list_status(c, F.lit(2), allowed)) == status


@pytest.mark.parametrize("answer, status", [
    ("体验问题：1.a<sep0>2.b<sep1>推理原因：1.c<sep0>2.d", "ok"),
    ("体验问题：1.a<sep1>推理原因：1.c<sep1>\n", "ok"),
    ("体验问题：1.a", "omitted"),
    ("体验问题：1.a<sep0>推理原因：1.c", "separator"),
    ("体验问题：1.a<sep0>2.b<sep1>推理原因：1.c", "pair_count"),
    (None, "missing"),
])
def test_issue_answers(spark, answer, status):
    assert one(spark, answer, A.issue_list_status) == status


def test_sections(spark):
    answer = "So 体验问题：1.a<sep0>2.b<sep1>\n推理原因：1.c\nd<sep0>2.e<sep1>"
    assert one(spark, answer, A.issues_of) == "1.a,2.b"
    assert one(spark, answer, A.paired_reasons_of) == "1.c\nd,2.e"
    assert one(spark, "x 推理原因： 1.a<sep>2.b \n", A.reasons_of) == "1.a,2.b"


@pytest.mark.parametrize("answer, found", [
    ("标签：1.等候时间<sep>2.包装破损", ["等候时间", "包装破损"]),
    ("1.prices<sep>", ["prices"]),              # not "ric"
    ("1.price level<sep>10.staff", ["price", "staff"]),
    ("no list", []),
])
def test_numbered_labels(spark, answer, found):
    assert one(spark, answer, A.numbered_labels) == found


@pytest.mark.parametrize("answer, decision", [
    ("y", "accept"), ("n", "redo"), ("n<sep>fewer", "redo"), ("no idea", "invalid"), ("yes", "invalid"),
    ("1.价格<sep>2.staff", "replace"), ("1.price level", "invalid"), ("", "invalid"),
])
def test_review_decision(spark, answer, decision):
    assert one(spark, answer, A.review_decision) == decision


def test_review_replaces_labels_and_adds_fallback(spark):
    proposed = labels.label_frame(spark, ["a", "b"])
    reviews = spark.createDataFrame([(1, "no idea"), (2, "1.x<sep>2.y<sep>3.x")], "review_id int, answer string")
    decision, hint, found = labels.reviewed_labels(proposed, reviews)
    assert (decision, hint) == ("replace", None)
    assert [tuple(r) for r in found.orderBy("label_id").collect()] == [(1, "x"), (2, "y"), (3, "其他问题")]


def test_bands_and_null(spark):
    df = spark.createDataFrame([(s,) for s in (None, 0, 3, 4, 6, 7, 10)], "s int")
    got = [r[0] for r in df.select(C.sentiment_band(F.col("s"))).collect()]
    assert got == [None, "negative", "negative", "neutral", "neutral", "positive", "positive"]


def test_golden_shares_of_the_documented_example(spark):
    """120 negatives: counts 8, 1, 11 with score sums 13, 2, 18; displays of 15, 14 and 12."""
    parts = {"a": (8, 13), "b": (1, 2), "c": (11, 18), "d": (15, 0), "e": (14, 0), "f": (12, 0), "g": (59, 0)}
    rows = [(name, total if i == 0 else 0) for name, (n, total) in parts.items() for i in range(n)]
    df = spark.createDataFrame(rows, "class string, score int")
    got = {r["class"]: r for r in rollup.class_summary(df, "class", "score").withColumn(
        "shown", C.percent_text(F.col("percentage"))).collect()}
    assert (got["a"]["percentage"], got["a"]["score"]) == (8 / 120, 1.625)
    assert (got["b"]["percentage"], got["b"]["score"]) == (1 / 120, 2.0)
    assert (got["c"]["percentage"], got["c"]["score"]) == (11 / 120, 18 / 11)
    assert [got[k]["shown"] for k in "def"] == ["12.5%", "11.67%", "10.0%"]


def test_null_class_stays_in_the_total(spark):
    df = spark.createDataFrame([("a",), (None,), (None,), ("b",)], "class string")
    got = {r["class"]: r["percentage"] for r in rollup.group_shares(df, "class").collect()}
    assert got == {"a": 0.25, "b": 0.25}


@pytest.mark.parametrize("text, words", [
    ("价格太高", ["价格", "格太", "太高"]),
    ("wifi很慢 Really", ["wifi", "很慢", "really"]),
    ("The 123 rooms 4th a x2", ["rooms", "4th", "x2"]),
    ("房", []), ("", []), (None, []),
    ("a<sep>bad", ["sep", "bad"]),
])
def test_words(spark, text, words):
    df = spark.createDataFrame([(1, text)], "row_id int, content string")
    assert with_tokens(df, stop_words=["the"]).first()["tokens"] == words


def test_user_segmenter(spark):
    df = spark.createDataFrame([(1, "Aa bb 12 c"), (2, "the dd")], "row_id int, content string")
    got = with_tokens(df, stop_words=["the"], segmenter=lambda texts: [t.split(" ") for t in texts])
    assert [r["tokens"] for r in got.orderBy("row_id").collect()] == [["aa", "bb"], ["dd"]]


def test_blank_texts_are_set_apart(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, " \n")], "row_id int, content string")
    usable, rest = split_usable(df)
    assert [r.row_id for r in usable.collect()] == [1]
    assert sorted(r.row_id for r in rest.collect()) == [2, 3]


@pytest.mark.parametrize("curve, k", [
    ([(1, 10.0), (2, 4.0), (3, 3.0), (4, 2.0)], 2),
    ([(1, 3.0), (2, 2.0), (3, 1.0)], 1),         # straight line
    ([(1, 4.0), (2, 1.0), (3, 0.0), (4, 1.0), (5, 4.0)], 3),
    ([(1, 5.0)], 1),
    ([(1, 9.0), (2, 4.0), (3, 3.0), (4, 6.0)], 2),
])
def test_elbow(spark, curve, k):
    got = elbow_curve(spark.createDataFrame(curve, "k int, sse double"))
    assert [r.k for r in got.filter("is_elbow").collect()] == [k]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="sep<>1 0x", max_size=6), min_size=1, max_size=5))
def test_split_never_cuts_items(spark, items):
    items = [i.replace("<sep>", "").strip() or "0" for i in items]
    answer = "<sep>".join(items)
    if "<sep>" in "".join(items) or answer.count("<sep>") != len(items) - 1:
        return
    assert one(spark, answer, A.split_items) == items


def test_columns_work_on_a_stream(spark, tmp_path):
    spark.range(11).select(F.col("id").cast("int").alias("score")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("score int").parquet(str(tmp_path / "in"))
    query = (stream.select("score", C.sentiment_band(F.col("score")).alias("band")).filter(C.is_negative(F.col("score")))
             .writeStream.format("memory").queryName("bands").trigger(availableNow=True).start())
    query.awaitTermination(60)
    assert spark.table("bands").count() == 4
