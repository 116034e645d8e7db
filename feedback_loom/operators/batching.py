"""Batches of texts and ordered text aggregation."""

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Batches that share one bucket; a bucket is sorted by one task.
BATCHES_PER_BUCKET = 100
DEFAULT_BATCH_SIZE = 30


def bucket_of(row_id: Column, buckets: int) -> Column:
    """Even spread of keys over buckets, independent of any partitioning."""
    digest = F.conv(F.substring(F.md5(row_id.cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(digest, F.lit(buckets))


def bucket_count(rows: int, batch_size: int) -> int:
    return max(1, -(-rows // (batch_size * BATCHES_PER_BUCKET)))


def assign_batches(df: DataFrame, row_id: str = "row_id", batch_size: int = DEFAULT_BATCH_SIZE,
                   rows: int | None = None, tasks: int | None = None) -> DataFrame:
    """Add ``bucket``, ``batch_no`` and ``pos`` (0-based place within the batch).

    Rows are numbered within hash buckets of about 100 batches, never globally,
    so the only exchange is by bucket and no task sees more than its buckets.
    ``rows`` (or an upper bound) saves the count; ``tasks`` fixes the number of
    partitions, which adaptive execution then leaves alone.
    """
    total = df.count() if rows is None else rows
    place = F.row_number().over(Window.partitionBy("bucket").orderBy(row_id)) - 1
    keyed = df.withColumn("bucket", bucket_of(F.col(row_id), bucket_count(total, batch_size)))
    if tasks is not None:
        keyed = keyed.repartition(tasks, "bucket")
    return (
        keyed.withColumn("__place", place)
        .withColumn("batch_no", F.floor(F.col("__place") / batch_size).cast("bigint"))
        .withColumn("pos", (F.col("__place") % batch_size).cast("int"))
        .drop("__place")
    )


def joined_texts(df: DataFrame, keys: list[str], text_col: str, order_col: str, sep: str,
                 out_col: str) -> DataFrame:
    """Per key: number of texts and the texts joined by ``sep`` in ``order_col`` order.

    Meant for groups bounded by a batch size or by a sample.
    """
    literal = sep.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n")
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.expr(f"listagg(`{text_col}`, '{literal}') WITHIN GROUP (ORDER BY `{order_col}`)").alias(out_col),
    )
