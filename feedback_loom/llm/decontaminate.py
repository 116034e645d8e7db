"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact verification.

A window of an item's number of words slides over each document. Window and item are
multisets of word shingles. With equal totals, a weighted similarity of p % needs a common
weight of at least 2p / (100 + p) of the total, so windows with fewer shingles that occur
in any item cannot match and are skipped before they are hashed; this drops no match.
The other windows get a 64-bit SimHash. Fingerprints within ``RADIUS`` of each other agree
up to ``RADIUS // 4`` bits in at least one of their four 16-bit blocks, so looking up
all block values that near finds every item within the radius. Candidates are
verified by exact weighted similarity (sum of smaller over sum of larger multiplicities).

A pair at a similarity of exactly 0.8 has expected 10 differing bits with a deviation of
3; beyond the radius of 23 lie less than 1 in 100,000.
"""

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import cut
from .columns import few_rows
from .words import Words, chained, shingles, slices, words_of

RADIUS, BLOCKS, BLOCK_BITS = 23, 4, 16
#: Items are searched in blocks of about this many bytes of text; one block's index goes to every task.
BLOCK_BYTES = 8 << 20
FILTER_BITS = 22
ONES = np.array([bin(i).count("1") for i in range(1 << BLOCK_BITS)], np.uint8)


def near_values(radius: int) -> np.ndarray:
    """All 16-bit masks with at most ``radius`` bits."""
    return np.array([sum(1 << b for b in bits) for n in range(radius + 1) for bits in combinations(range(BLOCK_BITS), n)],
                    np.uint16)


def votes(runs: np.ndarray) -> np.ndarray:
    """Running sums of +1 and -1 per bit over the hashes of shingles; one row more than hashes."""
    bits = np.unpackbits(runs.view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32) * 2 - 1
    return np.vstack([np.zeros((1, 64), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)])


def fingerprints(sums: np.ndarray) -> np.ndarray:
    """Sign bits of summed votes as four 16-bit blocks per row."""
    return np.ascontiguousarray(np.packbits(sums > 0, axis=1)).view(np.uint16)


def weighted_similarity(a, b) -> tuple[int, int]:
    """Sums of smaller and of larger multiplicities."""
    one, two = Counter(a), Counter(b)
    common = sum((one & two).values())
    return common, len(a) + len(b) - common


class SizeClass:
    """The items of one number of words, searched by blocks of their fingerprints."""

    def __init__(self, words: int, k: int, percent: int):
        self.words, self.k = words, min(k, words)
        self.total = words - self.k + 1
        self.need = -(-2 * percent * self.total // (100 + percent))
        self.ids: list[int] = []
        self.runs: list[list[int]] = []
        self.prints: np.ndarray | None = None

    def add(self, item_id: int, runs: np.ndarray) -> None:
        self.ids.append(item_id)
        self.runs.append(runs.tolist())

    def close(self) -> None:
        hashes = [np.array(r, np.uint64) for r in self.runs]
        self.prints = fingerprints(np.vstack([votes(r)[-1:] for r in hashes]))
        self.orders = [np.argsort(self.prints[:, b], kind="stable") for b in range(BLOCKS)]
        self.sorted = [self.prints[o, b] for b, o in enumerate(self.orders)]
        self.masks = near_values(RADIUS // BLOCKS)

    def near(self, mark: np.ndarray) -> np.ndarray:
        """Items within the radius of a fingerprint."""
        if len(self.ids) <= len(self.masks):
            # fewer items than values to look up: their block values are looked through instead
            blocks = ONES[self.prints ^ mark]
            found = np.flatnonzero((blocks <= RADIUS // BLOCKS).any(axis=1))
        else:
            parts = []
            for b in range(BLOCKS):
                wanted = self.masks ^ mark[b]
                low = np.searchsorted(self.sorted[b], wanted)
                high = np.searchsorted(self.sorted[b], wanted, "right")
                parts.extend(self.orders[b][x:y] for x, y in zip(low, high) if y > x)
            found = np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.int64)
        distance = ONES[self.prints[found] ^ mark].sum(axis=1)
        return found[distance <= RADIUS]


class ItemIndex:
    """All items of one block, by size."""

    def __init__(self, items: list[tuple[int, str]], k: int, percent: int):
        self.k, self.percent = k, percent
        classes: dict[int, SizeClass] = {}
        known: dict[int, list[np.ndarray]] = {}
        column = pa.array([text for _, text in items], pa.string())
        row = 0
        for _, _, data, offsets in slices(column):
            words = words_of(data, offsets)
            for a, b in zip(words.first[:-1], words.first[1:]):
                runs, n = shingles(words.hashes[a:b], k), int(b - a)
                if n:
                    classes.setdefault(n, SizeClass(n, k, percent)).add(items[row][0], runs)
                    known.setdefault(min(n, k), []).append(runs)
                row += 1
        for one in classes.values():
            one.close()
        self.classes = [classes[n] for n in sorted(classes)]
        self.known = {n: np.unique(np.concatenate(x)) for n, x in known.items()}
        self.filters = {}
        for n, values in self.known.items():
            bits = np.zeros(1 << FILTER_BITS, bool)
            bits[values >> np.uint64(64 - FILTER_BITS)] = True
            self.filters[n] = bits

    def hits(self, runs: np.ndarray, n: int) -> np.ndarray:
        """Which hashes occur in any item."""
        found = self.filters[n][runs >> np.uint64(64 - FILTER_BITS)]
        at = np.flatnonzero(found)
        place = np.searchsorted(self.known[n], runs[at])
        place[place == len(self.known[n])] = 0
        found[at] = self.known[n][place] == runs[at]
        return found

    def search(self, words: Words) -> Iterator[tuple[int, int, int, int, int, int]]:
        """(row, item, common weight, larger weight, first word, words) of each best window per row and item."""
        for size in self.known:
            runs = chained(words.hashes, size)
            hit = self.hits(runs, size)
            at = np.flatnonzero(hit)
            for row in np.unique(np.searchsorted(words.first, at, "right") - 1):
                first, last = int(words.first[row]), int(words.first[row + 1]) - size + 1
                if last > first:
                    for found in self.in_text(runs[first:last], hit[first:last], size):
                        yield int(row), *found

    def in_text(self, runs: np.ndarray, hit: np.ndarray, size: int) -> list[tuple[int, int, int, int, int]]:
        counts = np.concatenate([[0], np.cumsum(hit)])
        best: dict[int, tuple] = {}
        sums = None
        for one in self.classes:
            if one.k != size:
                continue
            total = min(one.total, len(runs))
            need = one.need if total == one.total else -(-self.percent * one.total // 100)
            starts = np.flatnonzero(counts[total:] - counts[:-total] >= need)
            if not len(starts):
                continue
            sums = votes(runs) if sums is None else sums
            marks = fingerprints(sums[starts + total] - sums[starts])
            for start, mark in zip(starts.tolist(), marks):
                for i in one.near(mark).tolist():
                    common, larger = weighted_similarity(runs[start:start + total].tolist(), one.runs[i])
                    if 100 * common >= self.percent * larger:
                        better = best.get(one.ids[i])
                        if better is None or common * better[1] > better[0] * larger:
                            best[one.ids[i]] = (common, larger, start, total + size - 1)
        return [(item, *found) for item, found in best.items()]


def leaks(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", item_text: str = "text",
          item_key: str = "item_id", k: int = 5, percent: int = 80) -> DataFrame:
    """``(key, item_id, similarity, first_word, n_words)``: every item found in a document, with its best window.

    The window has as many words as the item, or the whole document if that is shorter; an
    item of fewer than ``k`` words is one shingle. Ties go to the first window. Null and
    wordless texts and items match nothing; rows with a null key are not looked at; rows that
    repeat a key or an item give one row with the best window. Other columns are ignored.
    """
    spark = docs.sparkSession
    given = cut(items.where(F.col(item_key).isNotNull() & F.col(item_text).isNotNull())
                .select(F.col(item_key).cast("long").alias("item"), F.col(item_text).cast("string").alias("text")).distinct())
    size = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // BLOCK_BYTES))
    source = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long"), F.col(text).cast("string"))
    names = ["doc", "item_id", "common", "larger", "first_word", "n_words"]
    found = None
    for part in range(parts):
        block = given.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == part).orderBy("item", "text").collect()
        index = spark.sparkContext.broadcast(ItemIndex([tuple(r) for r in block], k, percent))

        def run(batches, index=index):
            for batch in few_rows(batches):
                rows = []
                for row, _, data, offsets in slices(batch.column(1)):
                    rows.extend((row + x[0], *x[1:]) for x in index.value.search(words_of(data, offsets)))
                columns = list(zip(*rows)) or [()] * 6
                docs_of = batch.column(0).take(pa.array(columns[0], pa.int64()))
                yield pa.RecordBatch.from_arrays([docs_of, *(pa.array(c, pa.int64()) for c in columns[1:])], names=names)

        one = source.mapInArrow(run, ", ".join(f"{n} long" for n in names))
        found = one if found is None else found.unionAll(one)
    best = found.groupBy("doc", "item_id").agg(
        F.max_by(F.struct("common", "larger", "first_word", "n_words"),
                 F.struct(F.col("common") / F.col("larger"), -F.col("first_word"))).alias("best"))
    return best.select(F.col("doc").alias(key), "item_id", (F.col("best.common") / F.col("best.larger")).alias("similarity"),
                       "best.first_word", "best.n_words")


def without_leaks(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", **rest) -> DataFrame:
    """The rows of ``docs`` in which no item is found; all columns stay."""
    return docs.join(cut(leaks(docs, items, text, key, **rest).select(key).distinct()), key, "left_anti")
