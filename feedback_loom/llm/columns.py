"""Names of columns that operators add."""

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import cut, join_sized

#: Rows of one key from which on a dealt join gives the key to several tasks.
DEALT = 1000


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns that an operator is about to add; names compare as Spark does, whatever their case."""
    lowered = {n.lower() for n in names}
    return df.select(*[quoted(c) for c in df.columns if c.lower() not in lowered])


def unused(df: DataFrame, name: str = "_value") -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def few_rows(batches, rows: int = 1024):
    """Batches in slices of some rows: what a task holds beside its batch stays small."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


def mapped(df: DataFrame, run, schema: T.StructType) -> DataFrame:
    """``mapInArrow`` for columns of any name; ``run`` sees and gives columns by place."""
    plain = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(schema.fields)])

    def renamed(batches):
        for batch in run(few_rows(batches)):
            yield pa.RecordBatch.from_arrays(batch.columns, names=plain.names)

    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]).mapInArrow(renamed, plain).toDF(*schema.names)


def dealt_parts(many: DataFrame, on: str) -> DataFrame:
    """``(on, _parts)``: the number of tasks for each key with more than ``DEALT`` rows."""
    return cut(many.groupBy(on).count().where(F.col("count") > DEALT).select(
        on, F.ceil(F.col("count") / DEALT).cast("int").alias("_parts")))


def join_dealt(many: DataFrame, one: DataFrame, on: str, by: str) -> DataFrame:
    """``many`` joined with ``one`` on a column; a key with more than ``DEALT`` rows of ``many`` goes to several tasks.

    The rows of such a key are dealt by the hash of the column ``by``, and its row of ``one`` is copied to every part, so
    the copies are few against the rows.
    """
    hot = dealt_parts(many, on)
    parts = F.coalesce("_parts", F.lit(1))
    dealt = join_sized(many, hot, on, "left").withColumn("_part", F.pmod(F.xxhash64(by), parts).cast("int")).drop("_parts")
    copied = join_sized(one, hot, on, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return dealt.join(copied, [on, "_part"]).drop("_part")
