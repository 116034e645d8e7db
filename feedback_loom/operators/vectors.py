"""TF-IDF over a capped vocabulary.

The vocabulary comes from one aggregation over words. Vectors are then made row
by row with MLlib transformers that share the vocabulary with the executors, so
weighting and normalising move no data at all.
"""

from dataclasses import dataclass

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, functions as F

MAX_FEATURES = 1000


@dataclass(frozen=True)
class Vocabulary:
    """Terms in alphabetical order with their inverse document frequencies."""

    terms: list[str]
    idf: list[float]
    n_docs: int

    def table(self, spark) -> DataFrame:
        rows = [(i, t, w) for i, (t, w) in enumerate(zip(self.terms, self.idf))]
        return spark.createDataFrame(rows, "idx int, term string, idf double")


def term_counts(tokenised: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """term, cf (occurrences) and df (texts that hold it), in one pass without a shuffle by text.

    Each text gives its words followed by its distinct words; the place of a word
    tells which of the two it counts for.
    """
    twice = F.posexplode(F.concat(F.col(tokens_col), F.array_distinct(tokens_col))).alias("place", "term")
    occurrence = F.col("place") < F.col("n")
    return (
        tokenised.select(F.size(tokens_col).alias("n"), twice)
        .groupBy("term")
        .agg(F.count_if(occurrence).alias("cf"), F.count_if(~occurrence).alias("df"))
    )


def top_vocabulary(tokenised: DataFrame, max_features: int = MAX_FEATURES,
                   tokens_col: str = "tokens") -> DataFrame:
    """The most frequent terms, ties by term (a distributed top-n)."""
    return term_counts(tokenised, tokens_col).orderBy(F.desc("cf"), "term").limit(max_features)


def smoothed_idf(df_col, n_docs):
    return F.log((1 + n_docs) / (1 + df_col)) + 1


def fit_vocabulary(tokenised: DataFrame, max_features: int = MAX_FEATURES,
                   tokens_col: str = "tokens") -> Vocabulary:
    n_docs = tokenised.count()
    rows = (
        top_vocabulary(tokenised, max_features, tokens_col)
        .select("term", smoothed_idf(F.col("df"), F.lit(float(n_docs))).alias("idf"))
        .collect()  # at most max_features rows
    )
    rows.sort(key=lambda r: r.term)
    return Vocabulary([r.term for r in rows], [r.idf for r in rows], n_docs)


def tfidf_vectors(tokenised: DataFrame, vocabulary: Vocabulary, tokens_col: str = "tokens",
                  out_col: str = "features") -> DataFrame:
    """Add unit-length TF-IDF vectors; a text without vocabulary terms gets the zero vector."""
    terms = vocabulary.terms or [""]
    idf = vocabulary.idf or [1.0]
    counts = CountVectorizerModel.from_vocabulary(terms, inputCol=tokens_col, outputCol="__tf")
    weigh = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="__tf", outputCol="__tfidf")
    unit = Normalizer(p=2.0, inputCol="__tfidf", outputCol=out_col)
    return unit.transform(weigh.transform(counts.transform(tokenised))).drop("__tf", "__tfidf")


def entries(features_col: str = "features") -> Column:
    """Non-zero entries of a vector as an array of (i, v); a sparse vector is never filled up."""
    raw = F.unwrap_udt(F.col(features_col))
    places = F.coalesce(raw["indices"], F.sequence(F.lit(0), F.size(raw["values"]) - 1))
    pairs = F.zip_with(places, raw["values"], lambda i, v: F.struct(i.alias("i"), v.alias("v")))
    return F.filter(pairs, lambda e: e["v"] != 0)


def long_weights(vectors: DataFrame, vocabulary: Vocabulary, keys: tuple[str, ...] = ("row_id",),
                 features_col: str = "features") -> DataFrame:
    """Non-zero weights as rows (keys, term, weight), expanded in place without a shuffle."""
    terms = F.lit(vocabulary.terms or [""])
    return (
        vectors.select(*keys, F.explode(entries(features_col)).alias("__e"))
        .select(*keys, F.get(terms, F.col("__e.i")).alias("term"), F.col("__e.v").alias("weight"))
    )
