"""Packing of token pieces into sequences of a fixed capacity by a configuration linear program.

Documents become token ids; longer ones are cut at the capacity. All that decides the packing is the
histogram of piece lengths, which has at most ``capacity`` entries whatever the size of the table, so it is
solved on the driver. A configuration is a multiset of lengths that fit one sequence; the linear program
asks for the fewest sequences, fractions allowed, that hold every length as often as it occurs. It is solved by
multiplicative weights, from several starts: every length has a price, a knapsack by dynamic programming finds the
configuration of the highest price, the solution takes as much of it as its scarcest length allows,
and the prices of what it covers fall exponentially in the share covered. Rounding takes whole
multiples of each configuration; lengths that remain, from the rounding and from the last of the
rounds, go best-fit into the gaps, longest first, and into new sequences.

All of this works on groups of equal sequences, so the plan's size follows the capacity and the number of
rounds, not the rows. It is broadcast as intervals of ranks: the pieces of one length are numbered in hash buckets
(a length that a third of all pieces share is many buckets), and a piece's rank gives its sequence and its place.
"""

import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import join_sized, to_table
from .columns import few_rows
from .words import slices, words_of

CAPACITY, END = 4096, 1
#: Rounds of the linear program, lengths priced in each, and the rate at which prices of classes fall.
ROUNDS, PRICED, RATE = 400, 256, 0.5
#: Classes of lengths whose dual values are learned.
CLASSES = 48
#: Words a worker remembers with their ids; beyond, it goes on with those of the slice at hand.
REMEMBERED = 1 << 19
#: Rows of a bucket in which pieces of one length are numbered, and most buckets.
BUCKET_ROWS, BUCKETS = 1024, 1 << 16


#: Marks before which a word is cut, and the letters they must follow.
MARKS, LETTERS = np.zeros(256, bool), np.zeros(256, bool)
MARKS[list(b".,;:!?")] = True
LETTERS[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True


class WordEncoder:
    """Ids of whole texts under a vocabulary that drops white space, so that words are encoded once and remembered.

    Words are maximal runs without blanks and the control characters 9 to 13, cut before a mark of ``MARKS`` that follows an
    ASCII letter. No token, special token or normalisation of such a vocabulary reaches over these places, so a text's
    ids are those of its words in order. Words that differ in the case of ASCII letters share their ids, but where
    a special token may stand.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        marks = [(t.content, n) for n, t in self.tokenizer.get_added_tokens_decoder().items()
                 if t.special and not t.normalized and t.content.startswith("<|")]
        self.mark = marks[0] if marks else None
        self.known = np.zeros(0, np.uint64)
        self.start, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after another, and how many each has.

        Many words are one call, with a special token between them, which nothing reaches over and which marks the places.
        """
        if self.mark is None or any("<|" in w for w in words):
            found = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
            return np.array([i for f in found for i in f], np.uint32), np.array([len(f) for f in found], np.int64)
        name, number = self.mark
        ids = np.array(self.tokenizer.encode_batch_fast([name.join(words)], add_special_tokens=False)[0].ids, np.uint32)
        marks = np.flatnonzero(ids == number)
        return np.delete(ids, marks), np.diff(np.concatenate([[-1], marks, [len(ids)]])) - 1

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        ids, sizes = zip(*(self._encoded(words[i:i + 512]) for i in range(0, len(words), 512)))
        size = np.concatenate(sizes)
        start = len(self.ids) + np.cumsum(size) - size
        self.ids = np.concatenate([self.ids, *ids])
        known = np.concatenate([self.known, hashes])
        order = np.argsort(known)
        self.known = known[order]
        self.start, self.size = np.concatenate([self.start, start])[order], np.concatenate([self.size, size])[order]

    def encode(self, column) -> Iterator[np.ndarray]:
        """The ids of each text of an Arrow column; null is empty."""
        for _, _, data, offsets in slices(column):
            raw = data.tobytes()
            breaks = np.zeros(len(data), bool)
            breaks[1:] = MARKS[data[1:]] & LETTERS[data[:-1]]
            words = words_of(data, offsets, lower=b"<|" not in raw, breaks=breaks)
            hashes, first, number = np.unique(words.hashes, return_index=True, return_inverse=True)
            new = ~np.isin(hashes, self.known, assume_unique=True)
            if new.any():
                if len(self.known) + int(new.sum()) > REMEMBERED:
                    self.known, self.ids, new = self.known[:0], self.ids[:0], np.ones(len(hashes), bool)
                    self.start, self.size = self.start[:0], self.size[:0]
                at = first[new]
                self._learn(hashes[new], [raw[a:b].decode() for a, b in zip(words.starts[at].tolist(), words.ends[at].tolist())])
            place = np.searchsorted(self.known, hashes)
            size = self.size[place][number]
            until = np.cumsum(size)
            total = int(until[-1]) if len(until) else 0
            ids = self.ids[np.repeat(self.start[place][number] - until + size, size) + np.arange(total)]
            edges = np.append(0, until)[words.first].tolist()
            for a, b in zip(edges, edges[1:]):
                yield ids[a:b]


def pieces(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY, end: int = END,
           keep_ids: bool = False) -> DataFrame:
    """``(key, piece, start, length, ids_crc32[, ids])``: each text's ids and an end id, cut every ``capacity`` ids."""
    names = [key, "piece", "start", "length", "ids_crc32", "ids"][:6 if keep_ids else 5]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.uint32())]

    def run(batches):
        encoder = WordEncoder(path)
        for batch in few_rows(batches):
            columns, rows = [[] for _ in names[1:]], []
            for row, found in enumerate(encoder.encode(batch.column(1))):
                ids = np.append(found, np.uint32(end)).astype("<u4")
                for number, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start:start + capacity]
                    rows.append(row)
                    for column, value in zip(columns, (number, start, len(part), zlib.crc32(part), part)):
                        column.append(value)
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds)]
            if keep_ids:
                arrays[-1] = arrays[-1].cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *arrays],
                                             names=[f"c{i}" for i in range(len(names))])

    schema = "c0 long, c1 int, c2 long, c3 long, c4 long" + ", c5 array<long>" * keep_ids
    return docs.select(F.col(key).cast("long"), F.col(text).cast("string")).mapInArrow(run, schema).toDF(*names)


def knapsack(lengths: np.ndarray, copies: np.ndarray, prices: np.ndarray, capacity: int) -> dict[int, int]:
    """The lengths, each at most ``copies`` times, of the highest total price within ``capacity``."""
    best = np.zeros(capacity + 1)
    taken = []
    for length, most, price in zip(lengths.tolist(), copies.tolist(), prices.tolist()):
        most, times = min(most, capacity // length), 1
        while most:
            times = min(times, most)
            most -= times
            weight = length * times
            with_it = best[:-weight] + price * times
            better = with_it > best[weight:]
            if better.any():
                best[weight:][better] = with_it[better]
                taken.append((length, times, better))
            times *= 2
    found: dict[int, int] = {}
    left = int(best.argmax())
    for length, times, better in reversed(taken):
        weight = length * times
        if left >= weight and better[left - weight]:
            found[length] = found.get(length, 0) + times
            left -= weight
    return found


def prices(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> np.ndarray:
    """What a piece of each length is worth in sequences: approximate dual values of the linear program.

    Lengths are grouped into ``CLASSES`` classes of about the same number of tokens, each as long as its longest. In every
    round the configuration of the highest price is taken as often as its scarcest class allows; a
    class's price falls exponentially with the share by which it is covered in all. The mean of the normalised prices
    over the later rounds is the answer.
    """
    tokens = np.cumsum(lengths * counts)
    owner = np.minimum((tokens - lengths * counts / 2) * CLASSES // tokens[-1], CLASSES - 1).astype(np.int64)
    _, owner = np.unique(owner, return_inverse=True)
    many = np.bincount(owner, counts).astype(np.int64)
    size = np.zeros(len(many), np.int64)
    np.maximum.at(size, owner, lengths)
    covered = np.zeros(len(many))
    total = np.zeros(len(many))
    place = {n: i for i, n in enumerate(size.tolist())}
    for number in range(ROUNDS):
        price = size / capacity * np.exp(-RATE * (covered - covered.min()))
        one = knapsack(size, many, price, capacity)
        at, times = np.array([place[n] for n in one]), np.array(list(one.values()))
        covered[at] += times * (many[at] / times).min() / many[at]
        if number >= ROUNDS // 4:
            total += price / (price[at] @ times)
    return np.maximum.accumulate(total / total.max())[owner]


def configurations(lengths: np.ndarray, counts: np.ndarray, capacity: int, price: np.ndarray,
                   rate: float) -> list[tuple[dict[int, int], float]]:
    """Configurations and how often the linear program takes them, fractions allowed; no length is covered beyond its count.

    ``price`` is where the prices start, ``rate`` how fast those of covered lengths fall.
    """
    price = price.copy()
    covered = np.zeros(len(lengths))
    place = {length: i for i, length in enumerate(lengths.tolist())}
    found = []
    for number in range(ROUNDS):
        left = np.floor(counts - covered + 1e-9).astype(np.int64)
        open_ = np.flatnonzero(left > 0)
        if not len(open_):
            break
        if len(open_) > PRICED:
            # the dearest half, and others evenly over all lengths, from another one on in every round
            order = open_[np.argsort(-price[open_], kind="stable")]
            others = order[PRICED // 2:]
            turn = np.arange(PRICED - PRICED // 2) + number * 0.618 % 1
            picked = others[(turn * len(others) / len(turn)).astype(np.int64) % len(others)]
            open_ = np.unique(np.concatenate([order[:PRICED // 2], picked]))
        one = knapsack(lengths[open_], left[open_], price[open_], capacity)
        at, times = np.array([place[n] for n in one]), np.array(list(one.values()))
        amount = float(((counts[at] - covered[at]) / times).min())
        found.append((one, amount))
        covered[at] += times * amount
        price[at] *= np.exp(-rate * times * amount / counts[at])
    return found


@dataclass
class Group:
    """``count`` equal sequences: how often each length lies in one, in order, and the room left."""

    count: int
    room: int
    slots: list[tuple[int, int]] = field(default_factory=list)

    def split(self, count: int) -> "Group":
        self.count -= count
        return Group(count, self.room, list(self.slots))

    def put(self, length: int, times: int) -> None:
        self.slots.append((length, times))
        self.room -= length * times


def rounded(found: list[tuple[dict[int, int], float]], counts: dict[int, int], capacity: int) -> list[Group]:
    """Whole sequences that hold every length as often as it occurs."""
    left = dict(counts)
    groups: list[Group] = []
    for one, amount in found:
        count = min(int(amount + 1e-9), *(left[n] // times for n, times in one.items()))
        if count:
            groups.append(Group(count, capacity))
            for length in sorted(one, reverse=True):
                groups[-1].put(length, one[length])
                left[length] -= one[length] * count
    by_room: dict[int, list[Group]] = {}
    rooms: list[int] = []

    def keep(group: Group) -> None:
        if group.room and not by_room.setdefault(group.room, []):
            insort(rooms, group.room)
        by_room.setdefault(group.room, []).append(group)

    for group in groups:
        keep(group)
    for length in sorted(left, reverse=True):
        many = left[length]
        while many:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                group = Group(-(-many // (capacity // length)), capacity)
                groups.append(group)
            else:
                group = by_room[rooms[at]].pop()
                if not by_room[rooms[at]]:
                    rooms.pop(at)
            times = min(group.room // length, many)
            if group.count > many // times:
                part = group.split(many // times)
                groups.append(part)
                keep(group)
                group = part
            group.put(length, times)
            many -= group.count * times
            keep(group)
    return groups


def solved(counts: dict[int, int], capacity: int) -> list[Group]:
    """The fewest sequences found from three starts of the prices; the first that meets a lower bound ends the search.

    Where short pieces fill every gap, a piece is worth its share of the capacity, and longer ones a little more, as
    they are harder to place. Where they do not, the learned dual values tell more.
    """
    lengths, many = np.array(list(counts), np.int64), np.array(list(counts.values()), np.int64)
    share = lengths / capacity
    least = max(-(-int(lengths @ many) // capacity), int(many[2 * lengths > capacity].sum()))
    best: list[Group] = []
    for start, rate in ((lambda: share * (1 + share / 8), 2.0), (lambda: share * (1 + 2 * share), 0.5),
                        (lambda: prices(lengths, many, capacity) + share ** 2 / 2, 0.5)):
        groups = rounded(configurations(lengths, many, capacity, start(), rate), counts, capacity)
        if not best or sum(g.count for g in groups) < sum(g.count for g in best):
            best = groups
        if sum(g.count for g in best) <= least:
            break
    return best


@dataclass
class Plan:
    """Intervals of ranks by length: rank ``first`` on goes to sequences from ``base`` on, ``count`` in turn, from ``offset`` on."""

    keys: np.ndarray
    count: np.ndarray
    base: np.ndarray
    offset: np.ndarray
    sequences: int

    def places(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, (length << 48) + rank, "right") - 1
        behind = rank - (self.keys[at] & ((1 << 48) - 1))
        copy, number = np.divmod(behind, self.count[at])
        return self.base[at] + number, self.offset[at] + copy * length


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Where the pieces of each length go, by their rank among those of the same length."""
    smaller = {n: counts[n] for n in sorted(counts) if n < capacity}
    whole = counts.get(capacity, 0)
    groups = solved(smaller, capacity) if smaller else []
    if whole:
        groups.append(Group(whole, 0, [(capacity, 1)]))
    rank = dict.fromkeys(counts, 0)
    rows, base = [], 0
    for group in groups:
        offset = 0
        for length, times in group.slots:
            rows.append(((length << 48) + rank[length], group.count, base, offset))
            rank[length] += times * group.count
            offset += length * times
        base += group.count
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return Plan(*table.T, base)


def numbered(parts: DataFrame, counts: dict[int, int]) -> DataFrame:
    """``parts`` (a written table with a unique ``row``) with ``rank``: from 0 on within each length.

    A length gets buckets by its count, so there are few more buckets than lengths, and than rows by ``BUCKET_ROWS``.
    """
    sizes = [(n, min(BUCKETS, -(-many // BUCKET_ROWS))) for n, many in counts.items()]
    sizes = parts.sparkSession.createDataFrame(sizes, "length long, buckets long")  # one row per length, of ``capacity`` at most
    parts = parts.join(F.broadcast(sizes), "length").withColumn("bucket", F.pmod(F.xxhash64("row"), "buckets"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    full = parts.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    full = to_table(full.select("length", "bucket", F.coalesce(before, F.lit(0)).alias("before")), "bucket_sizes")
    own = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("row")) - 1
    found = join_sized(parts.withColumn("own", own), full, ["length", "bucket"])
    return found.withColumn("rank", F.col("before") + F.col("own")).drop("bucket", "buckets", "own", "before")


def packed(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY, end: int = END,
           keep_ids: bool = False) -> DataFrame:
    """``(key, piece, start, length, ids_crc32[, ids], sequence_id, offset)``: every piece and its place.

    Null and empty texts are the end id alone. Rows that repeat a key are packed each, a null key stays null; which of
    several pieces of one length takes which place is fixed once the pieces are written. An empty table gives no rows.
    Other columns are ignored.
    """
    parts = pieces(docs, path, text, key, capacity, end, keep_ids)
    parts = to_table(parts.toDF("key", *parts.columns[1:]).withColumn("row", F.monotonically_increasing_id()), "pieces")
    counts = {r.length: r["count"] for r in parts.groupBy("length").count().collect()}
    shared = docs.sparkSession.sparkContext.broadcast(plan(counts, capacity))
    columns = [c for c in parts.columns if c != "row"]
    at = columns.index("length")
    found = numbered(parts, counts).select(*columns, "rank")
    names = [*columns, "sequence_id", "offset"]

    def run(batches):
        for batch in batches:
            rank = batch.column(len(columns)).to_numpy()
            places = shared.value.places(batch.column(at).to_numpy(), rank) if len(rank) else (rank, rank)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *(pa.array(p, pa.int64()) for p in places)], names=names)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema.fields[:-1])
    return found.mapInArrow(run, kinds + ", sequence_id long, offset long").toDF(key, *names[1:])
