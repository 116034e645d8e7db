"""Global numbers without moving all rows to one task."""

from pyspark.sql import DataFrame, Window, functions as F

from ..session import cut


def numbered(df: DataFrame, order: str, out: str) -> DataFrame:
    """Add ``out``: 1, 2, 3, ... in order of ``order``.

    Rows are sorted in range partitions and numbered within them; a partition starts behind the
    rows of those before it, of which one count each is summed up. Rows that are equal in
    ``order`` share a partition and are numbered in any order.
    """
    placed = cut(df.repartitionByRange(order).withColumn("__part", F.spark_partition_id()))
    counts = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    place = F.row_number().over(Window.partitionBy("__part").orderBy(order))
    # one row per partition
    return placed.join(F.broadcast(starts), "__part").withColumn(out, (place + F.col("__before")).cast("int")).drop("__part", "__before")
