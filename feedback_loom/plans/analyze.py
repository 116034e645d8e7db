"""From texts to a ranked list of quantified problems."""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..backends.base import Backend, LabelSet
from ..functions.columns import NEGATIVE_UP_TO, is_negative
from ..functions.tokens import stop_list, with_tokens
from ..operators.clusters import MAX_CLUSTERS, Clustering, cluster_texts
from ..operators.conclusion import conclusion_lines
from ..operators.labels import replaced_labels, valid_reviews
from ..operators.rollup import class_summary
from ..session import cut, drop_scratch, recorded_scratch, to_table
from ..sources.texts import default_stop_words


@dataclass
class Results:
    """The four result tables; then what a reviewer or a later run may need."""

    cluster_summary: DataFrame
    classified: DataFrame
    class_summary: DataFrame
    conclusion: DataFrame
    conclusion_text: DataFrame
    labels: DataFrame
    curve: DataFrame
    scored: DataFrame
    quarantine: DataFrame
    label_status: str
    #: Folders of the tables that the analysis wrote below the scratch folder.
    paths: list[str] = field(default_factory=list)

    def drop_tables(self, spark: SparkSession) -> None:
        """Delete what the analysis wrote; its frames cannot be read any more."""
        drop_scratch(spark, self.paths)

    def as_list(self) -> list[DataFrame]:
        return [self.cluster_summary, self.classified, self.class_summary, self.conclusion]


def _quarantine(step: str, key: str, table: DataFrame) -> DataFrame:
    return table.select(F.lit(step).alias("step"), F.col(key).cast("string").alias("key"), "status", "response")


def score_and_store(df: DataFrame, backend: Backend, content_col: str, score_col: str, batch_size: int,
                    negative_up_to: float = NEGATIVE_UP_TO, keep_texts: bool = False):
    """Scores of all rows, written once by part, with all their columns.

    A reader of the negatives opens their folder alone. Rows that have a score and are not negative
    keep their text only with ``keep_texts``; pending rows always do, so that the stored table can be
    resumed. A column ``part`` of an earlier run is written anew.
    """
    df = df.drop("part")
    answered = backend.score(df, content_col, score_col, batch_size)
    negative = is_negative(F.col(score_col), negative_up_to)
    part = F.when(negative, "negative").when(F.col(score_col).isNotNull(), "other").otherwise("pending")
    others = [c for c in answered.rows.columns if c not in ("row_id", score_col)]
    wanted = F.lit(keep_texts) | negative | F.col(score_col).isNull()
    kept = [F.when(wanted, F.col(c)).alias(c) if c == content_col else F.col(c) for c in others]
    stored = to_table(
        answered.rows.select("row_id", score_col, *kept, part.alias("part")), "scored", partition_by=("part",))
    return stored, answered.quarantine


def _empty_results(negatives: DataFrame, scored: DataFrame, quarantine: DataFrame, score_col: str,
                   class_col: str) -> Results:
    spark: SparkSession = negatives.sparkSession

    def empty(schema: str) -> DataFrame:
        return spark.createDataFrame([], schema)

    return Results(
        cluster_summary=empty("cluster int, keywords string, sample_cases string, comment_cnt bigint, "
                              "comment_pct double, issues string, reasons string"),
        classified=negatives.withColumns({
            "tokens": F.array().cast("array<string>"), "cluster": F.lit(None).cast("int"),
            class_col: F.lit(None).cast("string")}),
        class_summary=empty(f"`{class_col}` string, count bigint, percentage double, `{score_col}` double, reasons string"),
        conclusion=empty("rank int, class string, pct double, line string"),
        conclusion_text=spark.createDataFrame([("",)], "conclusion string"),
        labels=empty("label_id int, label string"),
        curve=empty("k int, sse double, fitted double, residual double, is_elbow boolean"),
        scored=scored,
        quarantine=quarantine,
        label_status="no_negative_texts",
    )


def choose_labels(backend: Backend, clustering: Clustering, summary: DataFrame,
                  reviews: DataFrame | None) -> LabelSet:
    """Propose a label set and apply the review table.

    Reviews are taken in order of their id. A redo proposes again with its hint and the next
    review judges that proposal, until one accepts or replaces it or the table ends. Clusters that
    no proposed label was made from are named in the status.
    """
    chosen = _chosen_labels(backend, clustering, summary, reviews)
    if chosen.left_out:
        chosen.status += f"; without clusters {', '.join(map(str, chosen.left_out))}"
    return chosen


def _chosen_labels(backend: Backend, clustering: Clustering, summary: DataFrame, reviews: DataFrame | None) -> LabelSet:
    proposed = backend.propose_labels(clustering, summary, None)
    if reviews is None:
        return proposed
    proposed.status = "pending_review"
    for review in valid_reviews(reviews):
        if review["decision"] == "accept":
            proposed.status = "accepted"
            return proposed
        if review["decision"] == "replace":
            labels = cut(replaced_labels(clustering.texts.sparkSession, review["labels"], proposed.fallback))
            names = [r.label for r in labels.orderBy("label_id").collect()]
            return LabelSet(labels, names, proposed.prototypes, "replaced", proposed.fallback)
        proposed = backend.propose_labels(clustering, summary, review["hint"])
        if not proposed.status.startswith("hint_"):
            proposed.status = "redone"
    return proposed


def analyze(df: DataFrame, backend: Backend, batch_size: int = 30, content_col: str = "content",
            score_col: str = "score", max_clusters: int = MAX_CLUSTERS, class_col: str = "class",
            reviews: DataFrame | None = None, stop_words: list[str] | DataFrame | None = None, segmenter=None,
            negative_up_to: float = NEGATIVE_UP_TO, parallelism: int = 8) -> Results:
    """Score, keep negatives, cluster, label, classify, summarise and conclude.

    ``df`` has a unique ``row_id`` (see ``sources.texts_from``) and the text column.
    An existing ``score_col`` is resumed: only rows without a score are asked for.
    """
    stop_words = stop_list(default_stop_words() if stop_words is None else stop_words)
    with recorded_scratch() as paths:
        found = _analyzed(df, backend, batch_size, content_col, score_col, max_clusters, class_col, reviews, stop_words,
                          segmenter, negative_up_to, parallelism)
    found.paths = list(paths)
    return found


def _analyzed(df, backend, batch_size, content_col, score_col, max_clusters, class_col, reviews, stop_words, segmenter,
              negative_up_to, parallelism) -> Results:
    scored, unscored = score_and_store(df, backend, content_col, score_col, batch_size, negative_up_to)
    negatives = scored.filter(F.col("part") == "negative").drop("part")
    quarantine = _quarantine("score", "row_id", unscored)
    if negatives.isEmpty():
        return _empty_results(negatives, scored, quarantine, score_col, class_col)

    clustering = cluster_texts(negatives, content_col, max_clusters, None, "row_id", stop_words, segmenter,
                               parallelism=parallelism)
    described = backend.describe(clustering, content_col)
    summary = to_table(described.rows, "cluster_summary")
    label_set = choose_labels(backend, clustering, summary, reviews)

    answered = backend.classify(clustering, clustering.texts, label_set, content_col, class_col, batch_size)
    classified = answered.rows
    if "tokens" not in classified.columns:
        # a model is sent keys and texts alone; words are found again
        classified = with_tokens(classified, content_col, "tokens", stop_words, segmenter)
    explained = backend.explain(clustering, classified, class_summary(classified, class_col, score_col),
                                content_col, class_col)
    classes = to_table(explained.rows, "class_summary")
    lines = conclusion_lines(classes, class_col)
    for step, key, part in (("describe", "cluster", described.quarantine), ("classify", "row_id", answered.quarantine),
                            ("explain", class_col, explained.quarantine)):
        quarantine = quarantine.unionByName(_quarantine(step, key, part))
    return Results(
        cluster_summary=summary,
        classified=classified.drop("features"),
        class_summary=classes,
        conclusion=lines,
        conclusion_text=backend.conclude(lines),
        labels=label_set.labels,
        curve=clustering.curve,
        scored=scored,
        quarantine=quarantine,
        label_status=label_set.status,
    )
