"""Counts that are kept up to date instead of taken anew.

A state is a table of sums per group: what was counted so far. States of parts of the rows add up to the state of all rows,
so a resumed run or the micro-batches of a stream count only their new rows. A ``StateTable`` keeps one part per batch
below a folder; a batch that is run again replaces its own part, so every row counts once.
"""

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.columns import as_double
from .vectors import term_counts

#: Columns of sums; all others are keys.
SUMS = ("n", "score_sum", "n_scored", "cf", "df")


def group_state(df: DataFrame, key: str, score_col: str | None = None) -> DataFrame:
    """``key``, rows ``n``, ``score_sum`` and ``n_scored`` (rows with a score), the null group included."""
    score = as_double(F.col(score_col)) if score_col else F.lit(None).cast("double")
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(score), F.lit(0.0)).alias("score_sum"),
                               F.count(score).alias("n_scored"))


def term_state(tokenised: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """``term``, ``cf`` and ``df``."""
    return term_counts(tokenised, tokens_col)


def added(*states: DataFrame) -> DataFrame:
    """The state of all rows from states of parts of them; sums combine before the shuffle."""
    rows = reduce(DataFrame.unionByName, states)
    keys = [c for c in rows.columns if c not in SUMS]
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in rows.columns if c in SUMS])


def shares(state: DataFrame, key: str, count_col: str = "count", share_col: str = "percentage",
           score_out: str = "score") -> DataFrame:
    """What ``rollup.group_shares`` gives over the rows themselves: count, share and mean score of each non-null group."""
    total = state.agg(F.sum("n")).scalar()
    mean = F.when(F.col("n_scored") > 0, F.col("score_sum") / F.col("n_scored"))
    return state.select(key, F.col("n").alias(count_col), (F.col("n") / total).alias(share_col),
                        mean.alias(score_out)).filter(F.col(key).isNotNull())


class StateTable:
    """The parts of a state below ``path``: one folder per batch, and one of those that were folded together.

    Folding keeps the number of parts small. A fold covers all batches up to its number; readers take the highest complete
    fold and the batches behind it, so a part that was cut off counts for nothing.
    Batches are numbered in the order in which they are added and are not run again once folded.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _parts(self, kind: str) -> dict[int, str]:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}-*/_SUCCESS")
        found = place.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(place) or []
        folders = [status.getPath().getParent().toString() for status in found]
        return {int(re.search(r"-([0-9]+)$", folder).group(1)): folder for folder in folders}

    def _live(self) -> tuple[int, list[str]]:
        folds = self._parts("fold")
        last = max(folds, default=-1)
        batches = self._parts("batch")
        fold = [folds[last]] if folds else []
        return last, fold + [batches[n] for n in sorted(batches) if n > last]

    def add(self, state: DataFrame, batch: int) -> None:
        """Put in the state of one batch; the same number again replaces it."""
        last = self._live()[0]
        if batch <= last:
            return  # already part of a fold
        state.write.mode("overwrite").parquet(f"{self.path}/batch-{batch}")

    def read(self) -> DataFrame | None:
        """The state of all rows so far; ``None`` before the first batch."""
        parts = self._live()[1]
        return added(self.spark.read.parquet(*parts)) if parts else None

    def fold(self) -> None:
        """Write all parts as one. Old parts stay on file until ``drop_folded``, for readers that have begun."""
        last, parts = self._live()
        upto = max(self._parts("batch"), default=-1)
        if upto > last and len(parts) > 1:
            added(self.spark.read.parquet(*parts)).write.mode("overwrite").parquet(f"{self.path}/fold-{upto}")

    def drop_folded(self) -> None:
        """Delete parts that the newest fold holds."""
        last = self._live()[0]
        for kind, bound in (("batch", last + 1), ("fold", last)):
            for number, folder in self._parts(kind).items():
                if number < bound:
                    place = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
                    place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)

    def sink(self, state_of: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
        """For ``writeStream.foreachBatch``: adds ``state_of(rows)`` of each micro-batch, once."""
        return lambda rows, batch: self.add(state_of(rows), batch)
