"""Counts, shares and means per group; pending counts."""

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..functions.columns import as_double, is_pending
from .numbering import numbered


def group_shares(df: DataFrame, key: str, score_col: str | None = None,
                 count_col: str = "count", share_col: str = "percentage",
                 score_out: str = "score") -> DataFrame:
    """Count, share of all rows and optional mean score per non-null group.

    One aggregation with map-side partial counts, so a hot group costs nothing
    extra. The total, the null group included, is a scalar over the grouped rows, which stay spread.
    """
    measures = [F.count(F.lit(1)).alias(count_col)]
    if score_col is not None:
        measures.append(F.avg(as_double(F.col(score_col))).alias(score_out))
    grouped = df.groupBy(key).agg(*measures)
    total = grouped.agg(F.sum(count_col)).scalar()
    columns = [F.col(key), F.col(count_col), (F.col(count_col) / total).alias(share_col)]
    if score_col is not None:
        columns.append(F.col(score_out))
    return grouped.select(*columns).filter(F.col(key).isNotNull())


def class_summary(df: DataFrame, class_col: str = "class", score_col: str | None = None) -> DataFrame:
    """class, count, percentage[, score] and an empty ``reasons``."""
    shares = group_shares(df, class_col, score_col, score_out=score_col or "score")
    return shares.withColumn("reasons", F.lit(None).cast("string"))


def pending_counts(df: DataFrame, result_col: str) -> DataFrame:
    """How many rows have their result and how many still lack it."""
    pending = is_pending(F.col(result_col))
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(pending).alias("pending"),
        F.count_if(~pending).alias("done"),
    )


def ranked_by_share(summary: DataFrame, class_col: str = "class", share_col: str = "percentage") -> DataFrame:
    """Add ``rank``: largest share first, ties by class. Input is one row per class; no task holds all of them."""
    order = F.struct((-F.col(share_col)).alias("share"), F.col(class_col).alias("class"))
    return numbered(summary.withColumn("__order", order), "__order", "rank").drop("__order")


def resume(df: DataFrame, stored: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Rows of ``df`` that have no stored result yet."""
    return df.join(stored.select(row_id), on=row_id, how="left_anti")


def merge_results(df: DataFrame, stored: DataFrame, result_col: str, row_id: str = "row_id") -> DataFrame:
    """Table with stored results filled in; a result already present is kept."""
    fresh = stored.select(row_id, F.col(result_col).alias("__fresh"))
    merged = F.coalesce(F.col(result_col), F.col("__fresh")) if result_col in df.columns else F.col("__fresh")
    return df.join(fresh, on=row_id, how="left").withColumn(result_col, merged).drop("__fresh")


def observed_progress(df: DataFrame, result_col: str, name: str = "progress"):
    """(frame, observation): counts that fill in while another action runs."""
    seen = Observation(name)
    pending: Column = is_pending(F.col(result_col))
    return df.observe(seen, F.count(F.lit(1)).alias("total"), F.count_if(pending).alias("pending")), seen
