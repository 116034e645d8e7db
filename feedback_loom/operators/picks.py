"""Bounded picks per group: first rows, seeded samples, top terms."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import join_sized, to_table

SALTS = 64


def sample_order(row_id: Column, seed: int = 1) -> Column:
    """Pseudo-random, repeatable order of rows."""
    return F.md5(F.concat(F.lit(f"{seed}:"), row_id.cast("string")))


def rank_within(df: DataFrame, keys: list[str], order: list[Column], n: int,
                spread_by: str | None = None, rank_col: str = "rn") -> DataFrame:
    """Keep the first ``n`` rows of every group, numbered in ``rank_col``.

    With ``spread_by`` a group is first cut to ``n`` rows in each of 64 hash
    slices, so a group that holds a third of the table is ranked by many tasks
    and at most 64 n of its rows reach the final one. The result is the same.
    """
    if spread_by is not None:
        slices = Window.partitionBy(*keys, "__slice").orderBy(*order)
        df = (
            df.withColumn("__slice", F.pmod(F.xxhash64(spread_by), F.lit(SALTS)))
            .withColumn("__rn", F.row_number().over(slices))
            .filter(F.col("__rn") <= n)
            .drop("__slice", "__rn")
        )
    whole = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(whole)).filter(F.col(rank_col) <= n)


def first_ids(df: DataFrame, key: str, n: int, row_id: str = "row_id") -> DataFrame:
    """First ``n`` row ids of each group in key order."""
    ids = df.select(key, row_id).filter(F.col(key).isNotNull())
    return rank_within(ids, [key], [F.col(row_id)], n, spread_by=row_id)


def sampled_ids(df: DataFrame, key: str, n: int, seed: int = 1, row_id: str = "row_id") -> DataFrame:
    """Seeded sample without replacement of at most ``n`` row ids per group."""
    ids = df.select(key, row_id).filter(F.col(key).isNotNull())
    order = [sample_order(F.col(row_id), seed), F.col(row_id)]
    return rank_within(ids, [key], order, n, spread_by=row_id)


def fetch(df: DataFrame, picks: DataFrame, row_id: str = "row_id", columns: tuple[str, ...] = ("content",)) -> DataFrame:
    """Texts of picked ids. Only ids are ranked; whole texts are read for picked rows alone."""
    picked = to_table(picks, "picked_ids")
    return join_sized(df.select(row_id, *columns), picked, on=row_id)


def top_terms(weights: DataFrame, key: str, n: int = 10, weight_col: str = "weight",
              term_col: str = "term") -> DataFrame:
    """Best ``n`` terms per group by weight, ties by term, none of weight zero.

    Input is one row per group and term, at most the vocabulary per group.
    """
    order = [F.round(weight_col, 6).desc(), F.col(term_col)]
    return rank_within(weights.filter(F.round(weight_col, 6) > 0), [key], order, n)
