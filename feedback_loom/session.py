"""Session settings, shared scratch space and size-checked joins.

Everything that must outlive one plan (answers of a model backend, vectors read
by many fits) is written to the folder the cluster names in
``spark.checkpoint.dir``, so it survives the loss of any executor.
"""

import uuid
from collections import Counter
from collections.abc import Callable
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Most bytes (rows written as JSON) a side may have before it is joined by shuffle instead of broadcast.
BROADCAST_BYTES = 32 << 20
#: Most rows of a label-by-vocabulary table that goes to every task; a row has a bounded key and two numbers.
BROADCAST_ROWS = 200_000


def build_session(app_name: str = "feedback_loom", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators are tuned for."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # one prompt holds a whole batch of texts, so Arrow batches count few rows
        "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
        "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written tables and checkpoints: ``spark.checkpoint.dir`` or what ``use_scratch`` set."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root and not context.getCheckpointDir():
        context.setCheckpointDir(root)
    root = root or context.getCheckpointDir()
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and every executor can reach")
    return root.rstrip("/")


def use_scratch(spark: SparkSession, path: str) -> None:
    """Take ``path`` for written tables and checkpoints where the session names no folder of its own."""
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)


_recorded: ContextVar[list[str] | None] = ContextVar("recorded", default=None)


@contextmanager
def recorded_scratch():
    """List the folders handed out within the block, so that they can be dropped later."""
    paths: list[str] = []
    token = _recorded.set(paths)
    try:
        yield paths
    finally:
        _recorded.reset(token)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    folder = f"{scratch_root(spark)}/feedback_loom/{uuid.uuid4().hex}"
    if (paths := _recorded.get()) is not None:
        paths.append(folder)
    return f"{folder}/{name}"


def drop_scratch(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders that ``scratch_path`` handed out, wherever the shared folder lies."""
    own = f"{scratch_root(spark)}/feedback_loom/"
    for path in paths:
        if not path.startswith(own):
            raise ValueError(f"{path} is no folder of this library")
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


#: Lets Spark delete the shuffle files of a query as soon as it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleaned_by: Counter = Counter()
_before: dict[int, str | None] = {}
_cleaning = Lock()


@contextmanager
def without_old_shuffles(spark: SparkSession):
    """Within the block the shuffle files of a query go when it ends, not when the driver happens to collect its garbage.

    For tables that are written and read again: a frame that a second action runs anew would shuffle anew too.
    """
    key = id(spark)
    with _cleaning:
        if not _cleaned_by[key]:
            _before[key] = spark.conf.get(CLEANUP, None)
            spark.conf.set(CLEANUP, "true")
        _cleaned_by[key] += 1
    try:
        yield
    finally:
        with _cleaning:
            _cleaned_by[key] -= 1
            if not _cleaned_by[key]:
                before = _before.pop(key)
                spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def to_table(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Later readers keep column pruning and filter pushdown, and never run the
    plan behind it (a model backend, say) a second time.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows are written and the plan behind them dropped."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


def _bytes() -> Column:
    return F.octet_length(F.to_json(F.struct("*")))


def combined_in_blocks(left: DataFrame, right: DataFrame, on: str, combine: Callable[[DataFrame], DataFrame],
                       max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``combine(left joined with right on a column)``, where ``combine`` gives partial results that the caller adds up.

    A small ``right`` (written or cached) is broadcast. A larger one is cut into blocks by a hash of ``on`` that are broadcast one
    after the other, each round's partial results written before the next. ``left`` is written once, split in the same
    way without an exchange, so a round reads its own rows only, and a value that very many rows have is no hot key.
    A block that is still too large, as one value has very many rows on the right, is sent in several rounds.
    """
    spark = left.sparkSession
    size = right.select(_bytes().alias("n")).agg(F.sum("n")).first()[0] or 0
    if size <= max_bytes:
        return combine(left.join(F.broadcast(right), on))
    # half full on average, as hashed blocks are not equally large
    block = F.pmod(F.xxhash64(on), F.lit(-(-2 * size // max_bytes))).cast("int")
    rows = right.withColumns({"__bytes": _bytes(), "__block": block, "__cut": F.xxhash64(*right.columns)})
    rounds = rows.groupBy("__block").agg(F.sum("__bytes").alias("n")).collect()  # one row per block
    rows = to_table(rows.drop("__bytes"), "blocks", ("__block",))
    split = to_table(left.withColumn("__block", block), "split", ("__block",))
    parts = []
    for found in rounds:
        sent = 1 if found["n"] <= max_bytes else -(-2 * found["n"] // max_bytes)
        mine = split.filter(F.col("__block") == found["__block"]).drop("__block")
        for turn in range(sent):
            piece = rows.filter((F.col("__block") == found["__block"]) & (F.pmod("__cut", F.lit(sent)) == turn))
            parts.append(to_table(combine(mine.join(F.broadcast(piece.drop("__block", "__cut")), on)), "partial"))
    return reduce(DataFrame.unionByName, parts)


def join_sized(left: DataFrame, right: DataFrame, on, how: str = "inner",
               max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Join a written or cached ``right``; broadcast only if its rows are proven small.

    ``right`` should be cheap to scan, as its bytes are summed first. A larger
    side is joined by shuffle under the adaptive skew rules.
    """
    size = right.select(_bytes().alias("n")).agg(F.sum("n")).first()[0] or 0
    if size <= max_bytes:
        right = F.broadcast(right)
    return left.join(right, on=on, how=how)
