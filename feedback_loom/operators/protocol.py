"""Asking a model in batches: prompt, answer, check, retry, write back.

Answers go to the files of a run (``ledger``), so neither later actions nor a lost
executor or driver cause a finished round to be asked again. Equal texts are asked
once: rows are grouped by a 128-bit hash of their text before batching, and the
answers spread to all rows of a text afterwards.
"""

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import answers as A
from ..session import drop_scratch, recorded_scratch, to_table, without_old_shuffles
from .batching import DEFAULT_BATCH_SIZE, assign_batches, bucket_count
from .ledger import PROMPTS_PER_TASK, RunLedger

# What a repeated prompt says about the fault of the answer before.
NOTES = {
    A.MISSING: "There was no answer. Give one item for every text.",
    A.COUNT: f"The number of items differed from the number of texts. Texts and items are separated by {A.ITEM_SEP}; "
             "give exactly one item per text.",
    A.FORMAT: f"An item was not a whole number from 0 to 10. Answer only with such numbers, separated by {A.ITEM_SEP}.",
    A.LABEL: f"An item was not in the label set. Use only labels of the set, separated by {A.ITEM_SEP}.",
    A.OMITTED: "A section was absent. Repeat the answer with every heading of the template.",
    A.SEPARATOR: f"The two lists must be separated by one {A.PAIR_LIST_SEP}.",
    A.PAIR_COUNT: f"Both lists must have the same number of items, separated by {A.PAIR_ITEM_SEP}.",
}

Ask = Callable[[Column], Column]

#: Texts of a block of pending texts, the hashes of which are broadcast at once.
TEXTS_PER_BLOCK = 250_000

#: Rows of one text from which on its answer is spread by broadcast; larger where that would be over 1,000 texts.
HOT_TEXT = 10_000
#: Tasks for each bucket, where buckets are dealt to tasks by a hash: few tasks get more than two of them, however many there are.
TASKS_PER_BUCKET = 3


@dataclass(frozen=True)
class ItemTask:
    """One answer item per text."""

    check: Callable[[Column, Column], Column]      # (answer, expected count) -> status
    value_type: str                                # type of an item
    notes: dict[str, str] = field(default_factory=lambda: NOTES)


@dataclass(frozen=True)
class GroupTask:
    """One answer per group."""

    check: Callable[[Column], Column]
    parse: dict[str, Callable[[Column], Column]]   # output column -> section of the answer
    notes: dict[str, str] = field(default_factory=lambda: NOTES)


def halving_sizes(batch_size: int = DEFAULT_BATCH_SIZE) -> list[int]:
    """Batch size per round; the last is 1, so one bad text ends up alone."""
    sizes = [batch_size]
    while sizes[-1] > 1:
        sizes.append(sizes[-1] // 2)
    return sizes


def note_for(status: Column, notes: dict[str, str]) -> Column:
    return reduce(lambda col, kv: col.when(status == kv[0], kv[1]), notes.items(), F.when(F.lit(False), ""))


def checked_items(batches: DataFrame, check: Callable[[Column, Column], Column]) -> DataFrame:
    """Add ``status`` and the answer ``items`` to (.., n, response)."""
    return (
        batches.withColumn("status", check(F.col("response"), F.col("n")))
        .withColumn("items", A.split_items(F.col("response")))
    )


def label_statuses(batches: DataFrame, keys: Sequence[str], allowed: DataFrame) -> DataFrame:
    """(keys, status) of label answers (keys, n, response) against a table ``allowed`` (item) of any size."""
    items = batches.select(*keys, F.explode(A.split_items(F.col("response"))).alias("item"))
    strange = items.join(allowed, "item", "left_anti").groupBy(*keys).agg(F.count(F.lit(1)).alias("__misses"))
    status = (F.when(F.col("response").isNull(), A.MISSING).when(A.item_count(F.col("response")) != F.col("n"), A.COUNT)
              .when(F.col("__misses") > 0, A.LABEL).otherwise(A.OK))
    return batches.join(strange, list(keys), "left").select(*keys, status.alias("status"))


def write_back(checked: DataFrame, row_ids_col: str = "row_ids", row_id: str = "row_id",
               value_col: str = "value") -> DataFrame:
    """The i-th item of a valid answer belongs to the i-th row of its batch."""
    return (
        checked.filter(F.col("status") == A.OK)
        .select("items", F.posexplode(row_ids_col).alias("__pos", row_id))
        .select(row_id, F.get("items", F.col("__pos")).alias(value_col))
    )


def call_tasks(spark: SparkSession, prompts: int = 0) -> int:
    """Tasks of a calling stage: enough to keep every core waiting for an answer, and few prompts in each."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")),
               -(-prompts // PROMPTS_PER_TASK))


def _batched_rows(pending: DataFrame, row_id: str, content_col: str, batch_size: int, rows: int) -> DataFrame:
    """One row per batch with its prompt and, in key order, the payloads of its rows without the texts, which are in the prompt.

    Calls are slow and small, so their tasks are never merged: the exchange by
    bucket has a fixed number of partitions. With fewer buckets than tasks (little
    text, then) the finished batches are spread instead.
    """
    tasks = call_tasks(pending.sparkSession, rows // batch_size)
    buckets = bucket_count(rows, batch_size)
    enough = buckets >= tasks

    def by_key(a: Column, b: Column) -> Column:
        return F.when(a["row_id"] < b["row_id"], -1).when(a["row_id"] > b["row_id"], 1).otherwise(0)

    keyed = assign_batches(pending, row_id, batch_size, rows, TASKS_PER_BUCKET * buckets if enough else None)
    grouped = keyed.groupBy("bucket", "batch_no").agg(
        F.count(F.lit(1)).cast("int").alias("n"),
        F.array_sort(
            F.collect_list(F.struct(F.col(row_id).alias("row_id"), "payload")), by_key
        ).alias("members"),
        F.array_sort(F.collect_set("note")).alias("notes"),
    )
    texts = F.transform("members", lambda m: A.without_delimiters(m["payload"][content_col]))
    body = F.array_join(texts, A.ITEM_SEP)
    batches = grouped.select(
        "n",
        F.transform("members", lambda m: m["payload"].dropFields(content_col)).alias("payloads"),
        F.concat_ws("\n\n", "notes", body).alias("prompt"),
    )
    return batches if enough else batches.repartition(tasks)


def distinct_texts(rows: DataFrame, content_col: str, row_id: str) -> DataFrame:
    """``rows`` (with ``__text``, the hash of the text) as one row per text: smallest id, text and number of copies."""
    return rows.groupBy("__text").agg(F.min(row_id).alias(row_id), F.first(content_col).alias(content_col),
                                      F.count(F.lit(1)).alias("__copies"))


def spread(rows: DataFrame, answers: DataFrame, n_rows: int, how: str = "inner") -> DataFrame:
    """``rows`` joined with the answer to their text by ``__text``.

    Texts with very many copies are no hot keys of the join: their answers, of ``max(HOT_TEXT, n_rows / 1000)``
    copies each and so 1,000 at most, are broadcast, and the others joined by shuffle.
    """
    hot = answers.where(F.col("__copies") > max(HOT_TEXT, n_rows // 1000))
    if hot.isEmpty():
        return rows.join(answers, "__text", how)
    of_hot = rows.join(F.broadcast(hot), "__text")
    others = rows.join(F.broadcast(hot.select("__text")), "__text", "left_anti")
    return of_hot.unionByName(others.join(answers.join(F.broadcast(hot.select("__text")), "__text", "left_anti"), "__text", how))


class PendingTexts:
    """The different texts that a round asks, written once and by blocks of their hash; answers are stored without them.

    ``keep`` leaves those that a round has to ask again: a block at a time meets the (broadcast) hashes of its own, is
    written anew and dropped, so texts are neither shuffled nor stored twice, however many there are.
    """

    def __init__(self, texts: DataFrame, most: int):
        self.spark = texts.sparkSession
        self.blocks = max(1, -(-most // TEXTS_PER_BLOCK))
        with recorded_scratch() as self.paths:
            self.parts = [to_table(texts.withColumn("__block", self._block()), "pending_texts", ("__block",) if self.blocks > 1 else ())]

    def _block(self) -> Column:
        return F.pmod(F.xxhash64("__text"), F.lit(self.blocks)).cast("int")

    def texts(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.parts)

    def keep(self, wanted: DataFrame, rows: int) -> None:
        """Only the texts of ``wanted`` (__text, status), of which there are ``rows``."""
        texts, wanted = self.texts().drop("status"), wanted.withColumn("__block", self._block())
        kept, before = [], self.paths
        with recorded_scratch() as self.paths:
            if self.blocks == 1 or rows <= TEXTS_PER_BLOCK:
                kept.append(to_table(texts.join(F.broadcast(wanted.drop("__block")), "__text"), "pending_texts", ("__block",) if self.blocks > 1 else ()))
            else:
                for block in range(self.blocks):
                    here = F.col("__block") == block
                    mine = texts.where(here).drop("__block").join(F.broadcast(wanted.where(here).drop("__block")), "__text")
                    kept.append(to_table(mine, "pending_texts").withColumn("__block", F.lit(block)))
                    self._drop_block(before, block)
        self.parts = kept
        drop_scratch(self.spark, before)

    def _drop_block(self, paths: list[str], block: int) -> None:
        if len(paths) == 1:
            drop_scratch(self.spark, [f"{paths[0]}/pending_texts/__block={block}"])
        else:
            drop_scratch(self.spark, [paths[block]])

    def drop(self) -> None:
        drop_scratch(self.spark, self.paths)


def annotate_rows(df: DataFrame, result_col: str, content_col: str, task: ItemTask, ask: Ask,
                  batch_size: int = DEFAULT_BATCH_SIZE, row_id: str = "row_id", instruction: str = "",
                  ledger: RunLedger | None = None, step: str = "items"):
    """Fill ``result_col`` where it is NULL; returns (all rows, quarantine).

    Every text is asked once, whatever its copies. Batches whose answer fails the check
    are asked again at half the size with a note on the fault, down to single texts. What
    fails even alone keeps NULL, in all its copies, and is listed in the quarantine with
    its raw answer, as are null and blank texts. Rounds are those of ``ledger``, or of a run without a name.
    """
    spark = df.sparkSession
    ledger = ledger or RunLedger(spark)
    columns = [c for c in df.columns if c != result_col]
    has_result = result_col in df.columns
    todo = df.filter(F.col(result_col).isNull()) if has_result else df
    usable = F.coalesce(F.col(content_col).rlike(r"\S"), F.lit(False))
    blank = todo.filter(~usable)
    given = todo.filter(usable).select(*columns, F.unhex(F.md5(content_col)).alias("__text"))
    narrow = given.select("__text", row_id, content_col)

    n_rows, digest = narrow.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("__text", row_id))).first()
    found, failed, pending = [], None, None
    try:
        with without_old_shuffles(spark):
            pending = PendingTexts(distinct_texts(narrow, content_col, row_id), n_rows)
            rows = pending.texts().count()
            fingerprint = f"{batch_size} {n_rows} {rows} {digest}"
            for turn, size in enumerate(halving_sizes(batch_size)):
                asked = pending.texts().select(row_id, F.struct(content_col, "__text", "__copies").alias("payload"),
                                               note_for(F.col("status"), task.notes).alias("note") if turn else F.lit(None).cast("string").alias("note"))
                batches = _batched_rows(asked, row_id, content_col, size, rows)
                # the check is written with the answer, so later reads filter on a stored column
                checked = ledger.asked(step, turn, batches, instruction, ask, lambda answered: checked_items(answered, task.check),
                                       "" if turn else fingerprint, call_tasks(spark, rows // size))
                found.append(checked.filter(F.col("status") == A.OK).select("items", F.posexplode("payloads").alias("pos", "payload"))
                             .select("payload.__text", "payload.__copies", F.get("items", F.col("pos")).cast(task.value_type).alias(result_col)))
                invalid = checked.filter(F.col("status") != A.OK)
                failed = invalid.select("status", "response", F.explode("payloads").alias("payload"))
                rows = invalid.agg(F.sum("n")).first()[0]
                if not rows or size == 1:
                    break
                pending.keep(failed.select("payload.__text", "status"), rows)
    finally:
        if pending is not None:
            pending.drop()
    failed = failed.select("payload.__text", "payload.__copies", "status", "response")
    answers = reduce(DataFrame.unionByName, found)
    wanted = [F.col(c) for c in columns] + [F.col(result_col).cast(task.value_type).alias(result_col)]
    done = spread(given, answers, n_rows, "left").select(*wanted)
    empty = blank.select(*columns, F.lit(None).cast(task.value_type).alias(result_col))
    parts = [df.filter(F.col(result_col).isNotNull()).select(*wanted)] if has_result else []
    quarantine = spread(given, failed, n_rows).select(*columns, "status", "response").unionByName(
        blank.select(*columns, F.lit("blank_text").alias("status"), F.lit(None).cast("string").alias("response")))
    return reduce(DataFrame.unionByName, [*parts, done, empty]), quarantine


def annotate_groups(groups: DataFrame, key: str, task: GroupTask, ask: Ask, max_attempts: int = 4, instruction: str = "",
                    ledger: RunLedger | None = None, step: str = "groups"):
    """Ask once per group (key, body); returns (key + parsed columns, quarantine).

    Groups are clusters or classes with a capped sample of texts each.
    """
    ledger = ledger or RunLedger(groups.sparkSession)
    pending = groups.select(key, "body", F.lit(None).cast("string").alias("note"))
    done, failed = [], None
    for attempt in range(max_attempts):
        batches = pending.select(key, "body", F.concat_ws("\n\n", "note", "body").alias("prompt"))
        checked = ledger.asked(step, attempt, batches, instruction, ask,
                               lambda answered: answered.withColumn("status", task.check(F.col("response"))))
        done.append(checked.filter(F.col("status") == A.OK).select(
            key, *[parse(F.col("response")).alias(name) for name, parse in task.parse.items()]))
        failed = checked.filter(F.col("status") != A.OK)
        if failed.isEmpty():
            break
        pending = failed.select(key, "body", note_for(F.col("status"), task.notes).alias("note"))
    return reduce(DataFrame.unionByName, done), failed.select(key, "status", "response")


def fill_groups(summary: DataFrame, answers: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Write group answers back to their rows; the rest of the row is kept."""
    fresh = answers.select(key, *[F.col(c).alias(f"__{c}") for c in columns])
    joined = summary.join(fresh, key, "left")
    return joined.select(*[
        F.coalesce(F.col(c), F.col(f"__{c}")).alias(c) if c in columns else F.col(c) for c in summary.columns
    ])
