"""Causes of a class: capped samples of texts, and their most typical sentences."""

from pyspark.sql import DataFrame, functions as F

from ..functions.tokens import words
from .batching import joined_texts
from .picks import fetch, rank_within, sampled_ids

CLUSTER_SAMPLE = 100
CLASS_SAMPLE = 500
SENTENCE_END = r"[.!?。！？\n]+"
MIN_SENTENCE = 20


def sampled_texts(texts: DataFrame, key: str, n: int, content_col: str = "content", seed: int = 1,
                  row_id: str = "row_id") -> DataFrame:
    """(key, row_id, rn, content) for a seeded sample per group."""
    return fetch(texts, sampled_ids(texts, key, n, seed, row_id), row_id, (content_col,))


def sample_bodies(texts: DataFrame, key: str, n: int, content_col: str = "content", seed: int = 1,
                  row_id: str = "row_id") -> DataFrame:
    """(key, body): the sampled whole texts of each group, one per line, in key order."""
    picked = sampled_texts(texts, key, n, content_col, seed, row_id)
    return joined_texts(picked, [key], content_col, row_id, "\n", "body").select(key, "body")


def sentences(texts: DataFrame, keys: list[str], content_col: str = "content",
              min_chars: int = MIN_SENTENCE) -> DataFrame:
    """Distinct trimmed sentences of at least ``min_chars`` characters per key."""
    return (
        texts.select(*keys, F.explode(F.split(content_col, SENTENCE_END)).alias("sentence"))
        .withColumn("sentence", F.trim("sentence"))
        .filter(F.length("sentence") >= min_chars)
        .distinct()
    )


def typical_sentences(texts: DataFrame, means: DataFrame, key: str, n: int = 10,
                      content_col: str = "content") -> DataFrame:
    """Best ``n`` sentences per group by the mean group weight of their distinct words.

    ``means`` is (key, term, weight); words outside the vocabulary weigh zero.
    """
    found = sentences(texts, [key], content_col)
    terms = found.select(key, "sentence", F.explode(F.array_distinct(words(F.col("sentence")))).alias("term"))
    scored = (
        terms.join(means.select(key, "term", "weight"), [key, "term"], "left")
        .groupBy(key, "sentence")
        .agg(F.round(F.sum(F.coalesce("weight", F.lit(0.0))) / F.count(F.lit(1)), 6).alias("typicality"))
    )
    return rank_within(scored, [key], [F.desc("typicality"), F.col("sentence")], n, spread_by="sentence")


def numbered_list(ranked: DataFrame, key: str, item_col: str, out_col: str) -> DataFrame:
    """Items of each group as ``1.first,2.second``."""
    lines = ranked.select(key, "rn", F.concat(F.col("rn").cast("string"), F.lit("."), item_col).alias("line"))
    return joined_texts(lines, [key], "line", "rn", ",", out_col).drop("n")


def typical_causes(texts: DataFrame, means: DataFrame, key: str, sample: int = CLASS_SAMPLE, n: int = 10,
                   content_col: str = "content", row_id: str = "row_id") -> DataFrame:
    """(key, reasons) from the sampled texts of each group."""
    picked = sampled_texts(texts, key, sample, content_col, 1, row_id)
    return numbered_list(typical_sentences(picked, means, key, n, content_col), key, "sentence", "reasons")
