"""The five stages and the whole analysis as objects, one ``batch_run`` each."""

from pyspark.sql import DataFrame

from ..backends.base import Backend, LabelSet
from ..functions.columns import pending_value
from ..operators.clusters import MAX_CLUSTERS, Clustering, cluster_texts
from ..operators.conclusion import conclusion_lines
from ..operators.rollup import class_summary
from ..session import to_table
from ..sources.texts import default_stop_words
from .analyze import Results, analyze, choose_labels


class SentimentScorer:
    def __init__(self, backend: Backend):
        self.backend = backend
        self.quarantine: DataFrame | None = None

    def batch_run(self, df: DataFrame, batch_size: int = 30, content_col: str = "content",
                  score_col: str = "score") -> DataFrame:
        answered = self.backend.score(df, content_col, score_col, batch_size)
        self.quarantine = answered.quarantine
        return to_table(answered.rows, "scored")


class ClusterDescriber:
    def __init__(self, backend: Backend, stop_words: list[str] | None = None, segmenter=None):
        self.backend = backend
        self.stop_words = stop_words
        self.segmenter = segmenter
        self.clustering: Clustering | None = None
        self.quarantine: DataFrame | None = None

    def batch_run(self, negatives: DataFrame, content_col: str = "content", max_clusters: int = MAX_CLUSTERS,
                  score_col: str | None = None) -> DataFrame:
        words = default_stop_words() if self.stop_words is None else self.stop_words
        self.clustering = cluster_texts(negatives, content_col, max_clusters, score_col,
                                        stop_words=words, segmenter=self.segmenter)
        answered = self.backend.describe(self.clustering, content_col)
        self.quarantine = answered.quarantine
        return to_table(answered.rows, "cluster_summary")


class LabelAssigner:
    def __init__(self, backend: Backend, clustering: Clustering):
        self.backend = backend
        self.clustering = clustering
        self.label_set: LabelSet | None = None
        self.quarantine: DataFrame | None = None

    def propose(self, summary: DataFrame, reviews: DataFrame | None = None) -> LabelSet:
        self.label_set = choose_labels(self.backend, self.clustering, summary, reviews)
        return self.label_set

    def batch_run(self, texts: DataFrame | None = None, batch_size: int = 30, content_col: str = "content",
                  class_col: str = "class") -> DataFrame:
        if self.label_set is None:
            raise ValueError("propose a label set first")
        texts = self.clustering.texts if texts is None else texts
        answered = self.backend.classify(self.clustering, texts, self.label_set, content_col, class_col, batch_size)
        self.quarantine = answered.quarantine
        return answered.rows


class CauseSummarizer:
    def __init__(self, backend: Backend, clustering: Clustering):
        self.backend = backend
        self.clustering = clustering
        self.quarantine: DataFrame | None = None

    def batch_run(self, classified: DataFrame, content_col: str = "content", score_col: str | None = None,
                  class_col: str = "class") -> DataFrame:
        summary = class_summary(classified, class_col, score_col)
        answered = self.backend.explain(self.clustering, classified, summary, content_col, class_col)
        self.quarantine = answered.quarantine
        return to_table(answered.rows, "class_summary")


class ConclusionWriter:
    def __init__(self, backend: Backend):
        self.backend = backend

    def batch_run(self, summary: DataFrame, class_col: str = "class") -> DataFrame:
        return self.backend.conclude(conclusion_lines(summary, class_col))


class FeedbackAnalysis:
    """All stages in a row over one table of texts."""

    def __init__(self, backend: Backend):
        self.backend = backend
        self.results: Results | None = None

    def batch_run(self, df: DataFrame, batch_size: int = 30, content_col: str = "content", score_col: str = "score",
                  max_clusters: int = MAX_CLUSTERS, class_col: str = "class",
                  reviews: DataFrame | None = None, **options) -> list[DataFrame]:
        fresh = df if score_col in df.columns else df.withColumn(score_col, pending_value("int"))
        self.results = analyze(fresh, self.backend, batch_size, content_col, score_col, max_clusters, class_col,
                               reviews, **options)
        return self.results.as_list()
