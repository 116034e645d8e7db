"""Near-duplicate documents by SuperMinHash signatures, banding, verification and union-find.

A document is the set of its distinct word shingles. Every shingle draws a random
permutation of the signature's slots, rank by rank; a slot keeps the smallest
``rank + fraction`` that reaches it. Ranks of one shingle are correlated (each slot
gets another one), which lowers the variance against independent hashes, and the
ranks still to come cannot win once every slot holds a smaller rank: the signature
stops early, after one rank for long documents.

Banding proposes pairs, whole signatures drop those far below the threshold, exact
Jaccard similarity on full shingle sets confirms the rest. With 32 bands of 5 slots a pair
at 0.8 shares no band with probability 3e-6, and 160 slots estimate it below 0.66 as rarely.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import cut, join_sized, to_table
from ..operators.components import components
from .columns import few_rows, join_dealt
from .words import Words, mix, over_texts, shingles_of, signed

SLOTS, BAND_ROWS = 160, 5
#: Standard errors by which an estimate may fall short of the threshold.
ERRORS = 4.5
#: Shingles of the members of a bucket that are compared at once (a larger set is a block of its own).
BLOCK_SHINGLES = 1 << 17
#: Rounds in which each document is compared with one other.
ROUNDS = 2
FRACTION = np.float64(2.0 ** -53)
STEP = np.uint64(0x9E3779B97F4A7C15)


def signature(elements: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash of a set of 64-bit hashes: the smallest rank + fraction at each slot."""
    n = len(elements)
    best = np.full(slots, np.inf)
    if not n:
        return best
    state = elements.copy()
    order = None
    rows = np.arange(n)
    for rank in range(slots):
        state = state + STEP
        draw = mix(state)
        fraction = (draw >> np.uint64(11)).astype(np.float64) * FRACTION
        span = slots - rank
        other = rank + ((draw & np.uint64(0xFFFFFFFF)) * np.uint64(span) >> np.uint64(32)).astype(np.int64)
        if rank == 0:
            slot = other
        else:
            if order is None:
                # the swaps of rank 0, made when a second rank turns out to be needed
                order = np.broadcast_to(np.arange(slots, dtype=np.int16), (n, slots)).copy()
                order[rows, first], order[rows, 0] = 0, first
            slot = order[rows, other].astype(np.int64)
            order[rows, other] = order[rows, rank]
            order[rows, rank] = slot
        np.minimum.at(best, slot, rank + fraction)
        if rank == 0:
            first = other
        if best.max() < rank + 1:
            break
    return best


def bands(sign: np.ndarray, rows: int = BAND_ROWS) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of the key."""
    parts = mix(sign.view(np.uint64)).reshape(-1, rows)
    keys = np.arange(len(parts), dtype=np.uint64)
    for i in range(rows):
        keys = mix(keys * STEP + parts[:, i])
    return keys


def _described(k: int, slots: int, rows: int):
    def each(words: Words) -> Iterator[tuple]:
        for runs in shingles_of(words, k):
            elements = np.unique(runs)
            if not len(elements):
                yield 0, 0, 0, None, None
                continue
            one, two = mix(elements).sum(), mix(elements ^ STEP).sum()
            sign = signature(elements, slots)
            short = (mix(sign.view(np.uint64)) & np.uint64(0xFF)).astype(np.uint8)
            yield (len(elements), *signed(np.array([one, two])).tolist(), signed(bands(sign, rows)), short.tobytes())
    return each


def described(docs: DataFrame, text: str = "text", key: str = "doc_id", k: int = 5, slots: int = SLOTS,
              rows: int = BAND_ROWS) -> DataFrame:
    """Set size, 128-bit hash of the set, band keys and one byte per signature slot of each row."""
    names = [key, "n_shingles", "set_a", "set_b", "bands", "signature"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
    each = _described(k, slots, rows)

    def run(batches):
        for batch in few_rows(batches):
            columns = list(zip(*over_texts(batch.column(1), each))) or [()] * len(types)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), *(pa.array(c, t) for c, t in zip(columns, types))], names=names)

    return docs.select(F.col(key).cast("long"), F.col(text).cast("string")).mapInArrow(
        run, f"{key} long, n_shingles long, set_a long, set_b long, bands array<long>, signature binary")


def shingle_sets(docs: DataFrame, text: str, key: str, k: int) -> DataFrame:
    """``(id, elements)``: the sorted distinct shingle hashes of each row as bytes."""
    def each(words: Words) -> Iterator[bytes]:
        for runs in shingles_of(words, k):
            yield np.unique(runs).tobytes()

    def run(batches):
        for batch in few_rows(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(over_texts(batch.column(1), each), pa.binary())],
                names=["id", "elements"])

    return docs.select(F.col(key).cast("long"), F.col(text).cast("string")).mapInArrow(run, "id long, elements binary")


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have 100 * intersection >= percent * union."""
    x, y = (x, y) if len(x) <= len(y) else (y, x)
    if 100 * len(x) < percent * len(y) or not len(x):
        return False
    place = np.searchsorted(y, x)
    place[place == len(y)] = 0
    common = int((y[place] == x).sum())
    return common > 0 and 100 * common >= percent * (len(x) + len(y) - common)


def _similar(percent: int):
    """Keep the pairs whose sets are similar."""
    def run(batches):
        for batch in batches:
            keep = [similar(*(np.frombuffer(v.as_buffer(), np.uint64) for v in pair), percent)
                    for pair in zip(batch.column(2), batch.column(3))]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
    return run


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that are similar on full sets ``(id, elements)``; only sets of paired documents are moved."""
    one, two = (join_sized(sets.toDF(c, f"of_{c}"), cut(pairs.select(c).distinct()), c, "left_semi") for c in ("a", "b"))
    both = join_dealt(pairs.join(two, "b"), one, "a", "b").select("a", "b", "of_a", "of_b")
    return both.mapInArrow(_similar(percent), "a long, b long").distinct()


class _Block:
    def __init__(self, members: list[dict]):
        self.ids = np.array([m["id"] for m in members], np.int64)
        self.components = [m["component"] for m in members]
        self.sets = [np.frombuffer(m["elements"], np.uint64) for m in members]
        self.sizes = np.array([len(s) for s in self.sets], np.int64)
        self.signatures = np.frombuffer(b"".join(m["signature"] for m in members), np.uint8).reshape(len(members), -1)
        self.bands = np.array([m["bands"] for m in members], np.int64)


def _between(least: float, percent: int):
    """Links of two blocks of a bucket, confirmed on full sets: a forest that joins the components as all links would.

    A pair that shares several buckets is left to the first of them, so it is compared once.
    """
    def run(batches):
        for batch in few_rows(batches, 1):
            found = []
            for bucket, blocks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sides = [_Block(b["members"]) for b in blocks]
                one, two = sides[0], sides[-1]
                parent: dict[int, int] = {}

                def root(x: int) -> int:
                    while parent.setdefault(x, x) != x:
                        parent[x] = x = parent[parent[x]]
                    return x

                for i, size in enumerate(one.sizes.tolist()):
                    at = np.flatnonzero((100 * np.minimum(size, two.sizes) >= percent * np.maximum(size, two.sizes))
                                        & ((one.ids[i] < two.ids) | (one is not two)))
                    at = at[(two.signatures[at] == one.signatures[i]).mean(axis=1) >= least]
                    shared = two.bands[at] == one.bands[i]
                    at = at[one.bands[i][shared.argmax(axis=1)] == bucket] if len(at) else at
                    for j in at.tolist():
                        x, y = root(one.components[i]), root(two.components[j])
                        if x != y and similar(one.sets[i], two.sets[j], percent):
                            parent[max(x, y)] = min(x, y)
                            found.append((int(one.ids[i]), int(two.ids[j])))
            a, b = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return run


def _blocks(placed: DataFrame, details: DataFrame) -> DataFrame:
    """``(bucket, blocks)``: every pair of blocks of each bucket of ``placed (bucket, id, component)``, spread by the pair."""
    sizes = placed.join(details.select("id", "size"), "id").groupBy("bucket").agg(F.sum("size").alias("shingles"))
    blocks = join_sized(placed, cut(sizes), "bucket").join(details, "id").withColumn(
        "n_blocks", F.ceil(F.col("shingles") / BLOCK_SHINGLES).cast("int")).withColumn(
        "block", F.pmod(F.xxhash64("id"), "n_blocks").cast("int"))
    blocks = to_table(blocks.groupBy("bucket", "block", "n_blocks").agg(F.collect_list(
        F.struct("id", "component", "signature", "bands", "elements")).alias("members")), "blocks")
    whole = blocks.where("n_blocks = 1").select("bucket", F.array(F.struct("block", "members")).alias("blocks"))
    other = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("other")
    cut_up = blocks.where("n_blocks > 1").select("bucket", "block", "members", other).groupBy(
        "bucket", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two")).agg(
        F.collect_list(F.struct("block", "members")).alias("blocks")).select("bucket", "blocks")
    return whole.unionByName(cut_up)


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", k: int = 5, percent: int = 80,
                    slots: int = SLOTS, rows: int = BAND_ROWS) -> DataFrame:
    """``(key, n_shingles, component_id, kept)`` for each row of ``docs``.

    ``component_id`` is the smallest key reachable over links of at least ``percent``
    similarity; ``kept`` says that the row's key is that one. Rows without words are
    linked with nothing. A null key takes part in nothing: its component is null and it
    is kept. Rows that share a key share a component. Other columns are ignored, and an
    empty table gives an empty result.

    Equal sets are grouped by their size and a 128-bit hash over all elements and go on as one row each. In each of ``ROUNDS``
    rounds every member is compared, on full sets, with one other: the smallest member of one of its band buckets, if that
    one is not in its component already. Buckets whose members then lie in more than one component are cut into blocks
    bounded by their shingles, and the blocks compared with one another inside tasks that hold both blocks' full sets; only
    links that join components leave a task. So no bucket is capped or collected, the rows made grow with the members, and no
    link between components is lost.
    """
    least = percent / 100 - ERRORS * (percent / 100 * (1 - percent / 100) / slots) ** 0.5
    rows_of = to_table(described(docs, text, key, k, slots, rows), "signatures")
    known = rows_of.where(F.col(key).isNotNull() & (F.col("n_shingles") > 0))
    same = ["set_a", "set_b", "n_shingles"]
    groups = known.groupBy(*same).agg(F.min(key).alias("id"), F.max(key).alias("last"))
    groups = cut(groups.where("id < last").select(*same, "id"))
    equal = cut(join_sized(known.select(key, *same), groups, same)
                .where(F.col("id") != F.col(key)).select(F.col("id").alias("a"), F.col(key).alias("b")).distinct())
    first = join_sized(known, equal.select(F.col("b").alias(key)), key, "left_anti").select(
        F.col(key).alias("id"), F.col("n_shingles").alias("size"), "bands", "signature")
    members = first.select("id", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.min("id").alias("a"), F.max("id").alias("last"))
    shared = cut(shared.where("a < last").select("bucket", "a"))
    placed = to_table(join_sized(members, shared, "bucket").select("bucket", "a", "id"), "buckets")
    ids = cut(placed.select(F.col("id").alias(key)).distinct())
    sets = to_table(shingle_sets(join_sized(docs, ids, key, "left_semi"), text, key, k), "shingle_sets")

    links, tried = equal, placed.select("a", F.col("id").alias("b")).limit(0)
    found = None
    for number in range(ROUNDS):
        pairs = placed.where("a <> id")
        if found is not None:
            of_a = found.select(F.col("id").alias("a"), F.col("component").alias("of_a"))
            pairs = join_sized(join_sized(pairs, found, "id", "left"), of_a, "a", "left").where(
                F.coalesce("component", "id") != F.coalesce("of_a", "a"))
        pick = F.max("a") if number else F.min("a")
        pairs = cut(pairs.groupBy(F.col("id").alias("b")).agg(pick.alias("a")).select("a", "b").join(tried, ["a", "b"], "left_anti"))
        if pairs.isEmpty():
            break
        more = cut(verified(pairs, sets, percent))
        tried = tried.union(pairs)
        if number and more.isEmpty():
            break
        links = links.union(more)
        found = components(links)
    found = components(links) if found is None else found

    placed = placed.join(found, "id", "left").select("bucket", "id", F.coalesce("component", "id").alias("component"))
    mixed = placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = cut(mixed.where("low < high").select("bucket"))
    placed = cut(join_sized(placed, mixed, "bucket", "left_semi"))
    if not placed.isEmpty():
        ids = cut(placed.select("id").distinct())
        details = join_sized(first, ids, "id", "left_semi").join(join_sized(sets, ids, "id", "left_semi"), "id")
        more = cut(_blocks(placed, details).mapInArrow(_between(least, percent), "a long, b long").distinct())
        if not more.isEmpty():
            found = components(links.union(more))
    judged = rows_of.select(key, "n_shingles").join(found.withColumnRenamed("id", key), key, "left")
    component = F.coalesce("component", key)
    return judged.select(key, "n_shingles", component.alias("component_id"),
                         F.coalesce(component == F.col(key), F.lit(True)).alias("kept"))


def without_near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", k: int = 5,
                            percent: int = 80) -> DataFrame:
    """The rows whose key stands for its group; of rows that repeat a key, one. All columns stay."""
    judged = near_duplicates(docs, text, key, k, percent)
    kept = judged.groupBy(key).agg(F.max("kept").alias("kept"), F.count("*").alias("copies"))
    kept = cut(kept.where("kept").select(key, "copies"))
    single = docs.join(kept.where("copies = 1").select(key), key, "left_semi")
    again = docs.join(kept.where("copies > 1").select(key), key, "left_semi").dropDuplicates([key])
    return single.unionByName(again).unionByName(docs.where(F.col(key).isNull()))
