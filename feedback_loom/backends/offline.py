"""The six steps as plain Spark plans, with no model service."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.answers import FALLBACK_LABEL
from ..functions.tokens import words
from ..operators.causes import CLASS_SAMPLE, CLUSTER_SAMPLE, numbered_list, sampled_texts, typical_causes, typical_sentences
from ..operators.clusters import Clustering, group_means, nearest_centroid, nearest_in_row
from ..operators.conclusion import conclusion_text
from ..operators.hints import merge_as_wished, sides, wished
from ..operators.labels import merge_groups, two_term_labels, with_fallback
from ..operators.picks import top_terms
from ..operators.protocol import fill_groups
from ..operators.vectors import long_weights
from ..session import BROADCAST_ROWS, cut, to_table
from .base import Answered, Backend, LabelSet
from .lexicon import lexicon_scores


class OfflineBackend(Backend):
    """Lexicon scores, cluster keywords as issues, typical sentences as reasons, nearest label by cosine."""

    def __init__(self, lexicon: DataFrame, n_issues: int = 5, n_reasons: int = 10, min_jaccard: float = 0.5,
                 min_similarity: float = 0.05):
        self.lexicon = lexicon
        self.n_issues = n_issues
        self.n_reasons = n_reasons
        self.min_jaccard = min_jaccard
        self.min_similarity = min_similarity

    def score(self, texts, content_col, score_col, batch_size):
        usable = F.coalesce(F.col(content_col).rlike(r"\S"), F.lit(False))
        others = [c for c in texts.columns if c != score_col]
        parts, todo = [], texts
        if score_col in texts.columns:
            parts.append(texts.filter(F.col(score_col).isNotNull()).select(*others, F.col(score_col).cast("int").alias(score_col)))
            todo = texts.filter(F.col(score_col).isNull())
        fresh = lexicon_scores(todo.select(*others), self.lexicon, content_col, score_col).withColumn(
            score_col, F.when(usable, F.col(score_col)))
        rows = reduce(DataFrame.unionByName, [*parts, fresh])
        quarantine = todo.select(*others).filter(~usable).select(
            "*", F.lit("blank_text").alias("status"), F.lit(None).cast("string").alias("response"))
        return Answered(rows, quarantine)

    def describe(self, clustering: Clustering, content_col):
        issues = top_terms(clustering.means, "cluster", self.n_issues)
        picked = sampled_texts(clustering.texts, "cluster", CLUSTER_SAMPLE, content_col)
        reasons = typical_sentences(picked, clustering.means, "cluster", self.n_issues, content_col)
        found = numbered_list(issues, "cluster", "term", "issues").join(
            numbered_list(reasons, "cluster", "sentence", "reasons"), "cluster", "full")
        rows = fill_groups(clustering.summary, cut(found), "cluster", ["issues", "reasons"])
        failed = rows.filter(F.col("issues").isNull()).select(
            "cluster", F.lit("no_terms").alias("status"), F.lit(None).cast("string").alias("response"))
        return Answered(rows, failed)

    def propose_labels(self, clustering, summary, hint):
        top = cut(top_terms(clustering.means, "cluster", 10))
        merged = merge_groups(top, "cluster", self.min_jaccard)
        named = cut(two_term_labels(top, merged, "cluster"))
        status = "ok"
        if hint:
            named, status = self._as_wished(top, named, hint)
        proposed = named.select("label_id", "label").distinct()
        labels = cut(with_fallback(proposed))
        names = [r.label for r in labels.orderBy("label_id").collect()]
        labelled = clustering.texts.select("cluster", "features").join(
            F.broadcast(named.select("cluster", "label")), "cluster")  # at most one row per cluster
        prototypes = cut(group_means(labelled, clustering.vocabulary, "label"))
        return LabelSet(labels, names, prototypes, status if len(names) > 1 else "empty_label_set")

    def _as_wished(self, top: DataFrame, named: DataFrame, hint: str) -> tuple[DataFrame, str]:
        """(labels of the clusters, status) as a hint asks; a hint without a wish that can be met changes nothing."""
        wishes = cut(wished(top.sparkSession.createDataFrame([(hint,)], "hint string")))
        ends = cut(sides(wishes, top, named, "cluster"))
        if ends.isEmpty():
            return named, "hint_not_supported"
        merged, contradicted = merge_as_wished(top, "cluster", ends, self.min_jaccard)
        unmet = not wishes.join(ends.select("no").distinct(), "no", "left_anti").isEmpty()
        status = "hint_contradicts_itself" if contradicted else "hint_partly_supported" if unmet else "ok"
        return cut(two_term_labels(top, merged, "cluster", apart=True)), status

    def _prototypes(self, clustering: Clustering, label_set: LabelSet) -> DataFrame:
        """Centroids of known labels; a label given by hand stands for its own words."""
        own = (
            label_set.labels.filter(F.col("label") != FALLBACK_LABEL)
            .select("label_id", "label", F.explode(words(F.regexp_replace("label", "_", " "))).alias("term"))
            .join(clustering.vocabulary.table(label_set.labels.sparkSession), "term")
            .groupBy("label_id", "label", "term").agg(F.first("idf").alias("weight"))
        )
        if label_set.prototypes is None:
            return own.select("label_id", "term", "weight")
        known = label_set.prototypes.join(label_set.labels, "label").select("label_id", "term", "weight")
        unknown = own.join(label_set.prototypes.select("label").distinct(), "label", "left_anti")
        return known.unionByName(unknown.select("label_id", "term", "weight"))

    def classify(self, clustering, texts, label_set: LabelSet, content_col, class_col, batch_size):
        prototypes = cut(self._prototypes(clustering, label_set))
        bound = len(label_set.names) * len(clustering.vocabulary.terms or [""])
        if bound <= BROADCAST_ROWS:
            # labels times vocabulary is a small matrix: every row finds its label where it is
            named = {r.label_id: r.label for r in label_set.labels.collect()}
            placed = nearest_in_row(texts, clustering.vocabulary, prototypes, "label_id")
            name = F.create_map(*[F.lit(x) for pair in named.items() for x in pair])[F.col("label_id")]
            found = F.when(F.col("similarity") >= self.min_similarity, name)
            rows = placed.withColumn("__label", found).drop("label_id", "similarity")
        else:
            nearest = nearest_centroid(long_weights(texts, clustering.vocabulary), prototypes, "label_id")
            assigned = nearest.filter(F.col("similarity") >= self.min_similarity).join(
                label_set.labels, "label_id").select("row_id", F.col("label").alias("__label"))
            rows = texts.join(assigned, "row_id", "left")
        label = F.coalesce("__label", F.lit(label_set.fallback))
        if class_col in texts.columns:
            label = F.coalesce(F.col(class_col), label)
        rows = rows.withColumn(class_col, label).drop("__label")
        none = texts.limit(0).select("row_id", F.lit("").alias("status"), F.lit("").alias("response"))
        return Answered(to_table(rows, "classified"), none)

    def explain(self, clustering, classified, summary, content_col, class_col):
        means = cut(group_means(classified, clustering.vocabulary, class_col))
        found = typical_causes(classified, means, class_col, CLASS_SAMPLE, self.n_reasons, content_col)
        rows = fill_groups(summary, cut(found), class_col, ["reasons"])
        failed = rows.filter(F.col("reasons").isNull()).select(
            class_col, F.lit("no_sentences").alias("status"), F.lit(None).cast("string").alias("response"))
        return Answered(rows, failed)

    def conclude(self, lines):
        return conclusion_text(lines)
