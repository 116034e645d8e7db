"""Clustering of TF-IDF vectors: sweep over k, elbow, assignment, cluster summary."""

from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.storagelevel import StorageLevel

from ..functions.columns import line_through
from ..functions.tokens import with_tokens
from ..session import BROADCAST_BYTES, combined_in_blocks, cut, to_table
from .batching import joined_texts
from .picks import fetch, first_ids, top_terms
from .rollup import group_shares
from .vectors import MAX_FEATURES, Vocabulary, entries, fit_vocabulary, long_weights, tfidf_vectors

MAX_CLUSTERS = 20
SEED = 1
#: Tasks of a core, over all fits that run at a time, from which on no more fits are begun.
TASKS_PER_CORE = 8


def lay_out(vectors: DataFrame, row_id: str = "row_id", partitions: int | None = None) -> DataFrame:
    """Fixed layout by key for the fits: written once, then kept in memory and on disk.

    KMeans depends on how rows are laid out. Hash partitions by key, sorted by
    key, are the same whatever the layout of the input was. ``partitions`` is
    their number, by default ``spark.sql.shuffle.partitions`` of the session; with the
    same number, fits over the same rows can be repeated.
    """
    partitions = partitions or int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = vectors.repartition(partitions, row_id).sortWithinPartitions(row_id)
    return cut(placed).persist(StorageLevel.MEMORY_AND_DISK)


def single_cluster_sse(vectors: DataFrame, features_col: str = "features") -> float:
    """Squared error around the mean, in closed form and one pass."""
    return _single_cluster(vectors, features_col)[0]


def _single_cluster(vectors: DataFrame, features_col: str) -> tuple[float, bool]:
    """Squared error around the mean, and whether half of all numbers or more are not zero, in one pass."""
    stats = vectors.select(
        Summarizer.metrics("mean", "normL2", "count", "numNonZeros").summary(F.col(features_col)).alias("s")
    ).first()["s"]
    if not stats["count"]:
        return 0.0, True
    mean, norm, filled = (stats[c].toArray() for c in ("mean", "normL2", "numNonZeros"))
    dense = filled.sum() >= len(filled) * stats["count"] * 0.5
    return float(max(0.0, (norm @ norm) - stats["count"] * (mean @ mean))), bool(dense)


def distinct_vectors(vectors: DataFrame, up_to: int, features_col: str = "features") -> int:
    """Number of different vectors, counted no further than ``up_to``; nothing but hashes is moved."""
    return vectors.select(F.xxhash64(entries(features_col)).alias("h")).distinct().limit(up_to).count()


@dataclass(frozen=True)
class Sweep:
    """Error per k and the fitted models (k = 1 needs none)."""

    curve: list[tuple[int, float]]
    models: dict[int, KMeansModel]

    def table(self, spark: SparkSession) -> DataFrame:
        return elbow_curve(spark.createDataFrame(self.curve, "k int, sse double"))


def fits_at_once(vectors: DataFrame, parallelism: int) -> int:
    """Fits that share the cores: as many as give each core some tasks, and two of many partitions, as each fit keeps all vectors."""
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    return max(1, min(parallelism, max(2, TASKS_PER_CORE * cores // max(1, vectors.rdd.getNumPartitions()))))


def sweep(vectors: DataFrame, max_clusters: int = MAX_CLUSTERS, seed: int = SEED,
          parallelism: int = 8, features_col: str = "features") -> Sweep:
    """Fit k = 1..max_clusters on laid-out vectors; a few fits run at a time, at most ``parallelism``.

    k never exceeds the number of different vectors.
    """
    top = max(1, distinct_vectors(vectors, max_clusters, features_col))
    single, dense = _single_cluster(vectors, features_col)
    # the solver that KMeans would choose by a pass of its own in every fit
    base = KMeans(seed=seed, featuresCol=features_col, predictionCol="cluster", solver="block" if dense else "row")
    # the column alone is a frame that is not persisted itself, so a fit keeps its rows as vectors for its some 30 passes;
    # of the persisted frame, every pass would decode all rows anew
    rows = vectors.select(features_col)

    def fit(k: int) -> tuple[int, KMeansModel]:
        return k, base.copy({base.k: k}).fit(rows)

    with ThreadPool(fits_at_once(vectors, parallelism)) as pool:
        run = inheritable_thread_target(vectors.sparkSession)(fit)
        models = dict(pool.map(run, range(top, 1, -1), chunksize=1))
    curve = [(1, single)]
    curve += [(k, float(models[k].summary.trainingCost)) for k in sorted(models)]
    return Sweep(curve, models)


def elbow_curve(curve: DataFrame) -> DataFrame:
    """(k, sse) with the chord through both ends, distance from it and the elbow mark.

    The curve has one row per tried k. On equal distances the smallest k wins.
    """
    ends = Window.partitionBy()
    fitted = line_through(
        F.col("k"),
        F.min("k").over(ends), F.min_by("sse", "k").over(ends),
        F.max("k").over(ends), F.max_by("sse", "k").over(ends),
    )
    by_distance = Window.partitionBy().orderBy(F.desc("residual"), "k")
    return (
        curve.withColumn("fitted", fitted)
        .withColumn("residual", F.abs(F.col("sse") - F.col("fitted")))
        .withColumn("is_elbow", F.row_number().over(by_distance) == 1)
    )


def best_k(curve: DataFrame) -> int:
    return elbow_curve(curve).filter("is_elbow").first()["k"]


def assign_clusters(vectors: DataFrame, fits: Sweep, k: int) -> DataFrame:
    """Add ``cluster`` with the sweep's own model for ``k``; no refit."""
    if k == 1:
        return vectors.withColumn("cluster", F.lit(0))
    return fits.models[k].transform(vectors)


def group_means(vectors: DataFrame, vocabulary: Vocabulary, key: str, features_col: str = "features") -> DataFrame:
    """Mean weight per (group, term): the centroid of a group as rows.

    Tasks send one partial mean vector per group, however large the group.
    """
    means = (
        vectors.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(Summarizer.mean(F.col(features_col)).alias("features"))
    )
    return long_weights(means, vocabulary, keys=(key,))


def nearest_centroid(weights: DataFrame, centroids: DataFrame, centroid_key: str,
                     row_id: str = "row_id", max_rows: int | None = None,
                     max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(row, closest centroid, cosine) for unit vectors given as rows.

    ``centroids`` holds (key, term, weight). ``max_rows`` is its proven bound: with
    it the table is broadcast; without it blocks of terms of at most ``max_bytes`` are, one after the other,
    and no row is moved by its term. Ties go to the smallest key. Rows that share no term with any centroid do not appear.
    """
    unit = centroids.groupBy(centroid_key).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("__norm"))
    scaled = centroids.join(F.broadcast(unit) if max_rows else unit, centroid_key).select(
        centroid_key, "term", (F.col("weight") / F.col("__norm")).alias("__c"))

    def products(joined: DataFrame) -> DataFrame:
        return joined.groupBy(row_id, centroid_key).agg(F.sum(F.col("weight") * F.col("__c")).alias("__p"))

    if max_rows:
        dots = products(weights.join(F.broadcast(scaled), "term"))
    else:
        # sums over blocks of terms add up to those over all terms
        partial = combined_in_blocks(weights, to_table(scaled, "centroids"), "term", products, max_bytes)
        dots = partial.groupBy(row_id, centroid_key).agg(F.sum("__p").alias("__p"))
    similar = dots.select(row_id, centroid_key, F.round("__p", 6).alias("similarity"))
    best = F.min_by(F.struct(centroid_key, "similarity"), F.struct(-F.col("similarity"), F.col(centroid_key)))
    return similar.groupBy(row_id).agg(best.alias("__b")).select(row_id, f"__b.{centroid_key}", "__b.similarity")


def nearest_in_row(texts: DataFrame, vocabulary: Vocabulary, centroids: DataFrame, centroid_key: str,
                   features_col: str = "features") -> DataFrame:
    """All rows and columns of ``texts`` with the closest centroid and its cosine; nothing is moved.

    ``centroids`` holds (key, term, weight) and is proven small (keys times vocabulary): it
    goes to the tasks as one matrix, and each batch of sparse unit vectors is multiplied
    with it. Ties go to the smallest key; a row without a common term gets nulls.
    """
    # one row per key and term, bounded by the caller
    weights = centroids.select(centroid_key, "term", "weight").collect()
    keys = sorted({r[0] for r in weights})
    place = {t: i for i, t in enumerate(vocabulary.terms)}
    matrix = np.zeros((len(place) or 1, len(keys)))
    for key, term, weight in weights:
        if term in place:
            matrix[place[term], keys.index(key)] += weight
    norms = np.sqrt(sum_of_squares(weights, keys))
    matrix /= np.where(norms > 0, norms, 1.0)
    held = texts.sparkSession.sparkContext.broadcast(matrix)

    @F.pandas_udf("array<double>")
    def cosines(columns: pd.DataFrame) -> pd.Series:
        found = [v @ held.value[i] if len(i) else np.zeros(held.value.shape[1]) for i, v in zip(columns["i"], columns["v"])]
        return pd.Series(found)

    pairs = entries(features_col)
    raw = cosines(F.struct(F.transform(pairs, lambda e: e["i"]).alias("i"), F.transform(pairs, lambda e: e["v"]).alias("v")))
    kind = centroids.schema[centroid_key].dataType.simpleString()
    if not keys:
        return texts.withColumns({centroid_key: F.lit(None).cast(kind), "similarity": F.lit(None).cast("double")})
    shared = F.transform("__c", lambda c: F.when(c > 0, F.round(c, 6)))
    best = F.array_max("__c")
    return (
        texts.withColumn("__c", raw).withColumn("__c", shared).withColumn("similarity", best)
        .withColumn(centroid_key, F.get(F.lit(keys).cast(f"array<{kind}>"),
                                        (F.array_position("__c", F.col("similarity")) - 1).cast("int")))
        .drop("__c")
    )


def sum_of_squares(weights: list, keys: list) -> np.ndarray:
    """Squared length of each centroid over all of its terms."""
    sums = dict.fromkeys(keys, 0.0)
    for key, _, weight in weights:
        sums[key] += weight * weight
    return np.array([sums[k] for k in keys])


def keyword_lists(means: DataFrame, key: str, n: int = 10) -> DataFrame:
    """Top terms of each group as one string."""
    listed = joined_texts(top_terms(means, key, n), [key], "term", "rn", ", ", "keywords")
    return listed.drop("n")


def sample_cases(texts: DataFrame, key: str, n: int = 5, content_col: str = "content",
                 row_id: str = "row_id") -> DataFrame:
    """First ``n`` texts of each group, one per line."""
    picked = fetch(texts, first_ids(texts, key, n, row_id), row_id, (content_col,))
    return joined_texts(picked, [key], content_col, "rn", "\n", "sample_cases").drop("n")


def cluster_summary(texts: DataFrame, means: DataFrame, n_clusters: int, content_col: str = "content",
                    score_col: str | None = None, n_keywords: int = 10, row_id: str = "row_id") -> DataFrame:
    """One row for every cluster 0..n-1, empty ones too.

    ``texts`` carries ``cluster``; ``means`` comes from :func:`group_means`.
    """
    spark = texts.sparkSession
    shares = group_shares(texts, "cluster", score_col, "comment_cnt", "comment_pct",
                          score_col or "score")
    columns = ["cluster", "keywords", "sample_cases", "comment_cnt", "comment_pct"]
    if score_col is not None:
        columns.append(score_col)
    return (
        spark.range(n_clusters).select(F.col("id").cast("int").alias("cluster"))
        .join(keyword_lists(means, "cluster", n_keywords), "cluster", "left")
        .join(sample_cases(texts, "cluster", 5, content_col, row_id), "cluster", "left")
        .join(shares, "cluster", "left")
        .withColumn("comment_cnt", F.coalesce("comment_cnt", F.lit(0).cast("bigint")))
        .withColumn("comment_pct", F.coalesce("comment_pct", F.lit(0.0)))
        .withColumn("keywords", F.coalesce("keywords", F.lit("")))
        .withColumn("sample_cases", F.coalesce("sample_cases", F.lit("")))
        .select(*columns, F.lit(None).cast("string").alias("issues"), F.lit(None).cast("string").alias("reasons"))
    )


@dataclass
class Clustering:
    """Texts with tokens, features and cluster; vocabulary, centroids, curve and summary."""

    texts: DataFrame
    vocabulary: Vocabulary
    means: DataFrame
    curve: DataFrame
    k: int
    summary: DataFrame


def cluster_texts(texts: DataFrame, content_col: str = "content", max_clusters: int = MAX_CLUSTERS,
                  score_col: str | None = None, row_id: str = "row_id", stop_words: list[str] | None = None,
                  segmenter=None, max_features: int = MAX_FEATURES, seed: int = SEED,
                  parallelism: int = 8, partitions: int | None = None) -> Clustering:
    """Tokenise, weigh, sweep, pick k by elbow, assign and summarise.

    Whole texts are read for their words, for the annotation and for the few sample
    cases; vocabulary and fits read words and vectors alone.
    """
    spark = texts.sparkSession

    def spelled(df: DataFrame) -> DataFrame:
        return with_tokens(df, content_col, "tokens", stop_words, segmenter)

    tokenised = to_table(spelled(texts.select(row_id, content_col)).select(row_id, "tokens"), "tokens")
    vocabulary = fit_vocabulary(tokenised, max_features)
    vectors = lay_out(tfidf_vectors(tokenised, vocabulary).select(row_id, "features"), row_id, partitions)
    fits = sweep(vectors, max_clusters, seed, parallelism)
    curve = fits.table(spark)
    k = curve.filter("is_elbow").first()["k"]
    # weighing and assigning work row by row, so the texts are annotated without a join
    annotated = to_table(assign_clusters(tfidf_vectors(spelled(texts), vocabulary), fits, k), "clustered_texts")
    vectors.unpersist()
    means = to_table(group_means(annotated, vocabulary, "cluster"), "centroids")
    summary = cluster_summary(annotated, means, k, content_col, score_col, row_id=row_id)
    return Clustering(annotated, vocabulary, means, curve, k, summary)
