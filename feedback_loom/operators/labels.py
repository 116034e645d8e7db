"""Label sets: proposing from clusters, merging, reviewing."""

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions import answers as A
from ..session import cut
from .components import components
from .numbering import numbered


def with_fallback(labels: DataFrame, fallback: str = A.FALLBACK_LABEL) -> DataFrame:
    """Append the fallback label after the last one (labels: label_id, label)."""
    last = labels.filter(F.col("label") != fallback)
    extra = last.agg(
        (F.coalesce(F.max("label_id"), F.lit(0)) + 1).cast("int").alias("label_id"), F.lit(fallback).alias("label"))
    return last.unionByName(extra)


def labels_of(answer: DataFrame, response_col: str = "response") -> DataFrame:
    """(label_id, label) of a numbered answer; a repeated label counts once."""
    found = A.numbered_labels(F.col(response_col))
    return answer.select(F.posexplode(F.array_distinct(found)).alias("pos", "label")).select(
        (F.col("pos") + 1).cast("int").alias("label_id"), "label")


def label_frame(spark: SparkSession, names: list[str]) -> DataFrame:
    return spark.createDataFrame([(i + 1, n) for i, n in enumerate(names)], "label_id int, label string")


def term_overlap(top: DataFrame, key: str, min_jaccard: float | None = None) -> DataFrame:
    """Jaccard similarity of the top-term sets of groups that share a term.

    ``top`` holds a few terms per group (ten, say); the join is on the term, so pairs that
    share nothing are never formed. With ``min_jaccard`` only pairs that reach it are given,
    and groups meet on their rarest terms alone: two sets that similar share one among
    the first ``size - ceil(min_jaccard * size) + 1`` of each, in one order of all terms.
    """
    sizes = top.groupBy(key).agg(F.count(F.lit(1)).alias("size"))
    sized = top.join(sizes, key)
    if min_jaccard:
        return _similar_groups(sized, key, min_jaccard)
    left = sized.select(F.col(key).alias("left_group"), "term", F.col("size").alias("left_size"))
    right = sized.select(F.col(key).alias("right_group"), "term", F.col("size").alias("right_size"))
    shared = (
        left.join(right, "term")
        .filter(F.col("left_group") < F.col("right_group"))
        .groupBy("left_group", "right_group", "left_size", "right_size")
        .agg(F.count(F.lit(1)).alias("shared"))
    )
    pairs = shared.select(
        "left_group", "right_group", "shared",
        (F.col("shared") / (F.col("left_size") + F.col("right_size") - F.col("shared"))).alias("jaccard"))
    return pairs


def _similar_groups(sized: DataFrame, key: str, min_jaccard: float) -> DataFrame:
    held_by = sized.groupBy("term").agg(F.count(F.lit(1)).alias("__df"))
    sets = sized.join(held_by, "term").groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("__df", "term"))).alias("__terms"))
    sets = cut(sets.select(F.col(key).alias("group"), F.col("__terms.term").alias("terms")))
    needed = F.size("terms") - F.ceil(F.size("terms") * min_jaccard - 1e-9).cast("int") + 1
    heads = sets.select("group", F.explode(F.slice("terms", F.lit(1), needed)).alias("term"))
    met = (heads.toDF("left_group", "term").join(heads.toDF("right_group", "term"), "term")
           .filter("left_group < right_group").select("left_group", "right_group").distinct())
    both = met.join(sets.toDF("left_group", "a"), "left_group").join(sets.toDF("right_group", "b"), "right_group")
    shared = both.withColumn("shared", F.size(F.array_intersect("a", "b")).cast("bigint"))
    return shared.select(
        "left_group", "right_group", "shared",
        (F.col("shared") / (F.size("a") + F.size("b") - F.col("shared"))).alias("jaccard")).filter(F.col("jaccard") >= min_jaccard)


def merge_groups(top: DataFrame, key: str, min_jaccard: float = 0.5) -> DataFrame:
    """(key, merged): every group with the smallest group it is linked to, directly or not."""
    links = term_overlap(top, key, min_jaccard).select(F.col("left_group").alias("a"), F.col("right_group").alias("b"))
    found = components(links).select(F.col("id").alias(key), "component")
    groups = top.select(key).filter(F.col(key).isNotNull()).distinct()
    return groups.join(found, key, "left").select(key, F.coalesce("component", key).alias("merged"))


def two_term_labels(top: DataFrame, merged: DataFrame, key: str, apart: bool = False) -> DataFrame:
    """(key, label_id, label): each merged group is named by the two best terms of its first group.

    Merged groups of one name share its label; with ``apart`` they do not, and the second is named ``a_b_2``.
    """
    named = (
        top.filter(F.col("rn") <= 2)
        .groupBy(key)
        .agg(F.expr("listagg(term, '_') WITHIN GROUP (ORDER BY rn)").alias("label"))
        .withColumnRenamed(key, "merged")
        .join(merged.select("merged").distinct(), "merged")
    )
    if apart:
        place = F.row_number().over(Window.partitionBy("label").orderBy("merged"))
        named = named.withColumn("place", place).select(
            "merged", F.when(F.col("place") == 1, F.col("label")).otherwise(F.concat_ws("_", "label", "place")).alias("label"))
    distinct = named.groupBy("label").agg(F.min("merged").alias("first"))
    ids = numbered(distinct, "first", "label_id").select("label", "label_id")
    return merged.join(named, "merged").join(ids, "label").select(key, "label_id", "label")


def review_routes(reviews: DataFrame, answer_col: str = "answer") -> DataFrame:
    """Decide each review: accept, redo with a hint, replace with own labels, or invalid."""
    answer = F.trim(F.col(answer_col))
    decision = A.review_decision(answer)
    return reviews.withColumns({
        "decision": decision,
        "hint": A.review_hint(answer),
        "labels": F.when(decision == "replace", A.numbered_labels(answer)),
    })


def valid_reviews(reviews: DataFrame) -> Iterator:
    """The valid reviews in order of ``review_id``, read one partition at a time as far as they are used."""
    routed = review_routes(reviews).filter(F.col("decision") != "invalid").orderBy("review_id")
    return iter(routed.select("decision", "hint", "labels").toLocalIterator())


def replaced_labels(spark: SparkSession, names: list[str], fallback: str = A.FALLBACK_LABEL) -> DataFrame:
    return with_fallback(label_frame(spark, list(dict.fromkeys(names))), fallback)


def reviewed_labels(proposed: DataFrame, reviews: DataFrame, fallback: str = A.FALLBACK_LABEL):
    """Apply the first valid review by id to the proposed labels.

    Returns (decision, hint, labels). Without a valid review the proposal stands
    as ``pending``. Reviews are a few rows written by people; ``plans.analyze`` reads on after a redo.
    """
    first = next(valid_reviews(reviews), None)
    if first is None:
        return "pending", None, with_fallback(proposed, fallback)
    if first["decision"] == "replace":
        return "replace", None, replaced_labels(proposed.sparkSession, first["labels"], fallback)
    return first["decision"], first["hint"], with_fallback(proposed, fallback)
