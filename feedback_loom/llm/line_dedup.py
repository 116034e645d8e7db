"""Line dedup by pairwise alignment: delete from later documents what an earlier one holds.

A text is cut into lines: at line ends, and behind sentence ends, as a passage may be
pasted inside a line. Lines compare by their lower-cased words. A rare line (of at
least ``RARE_WORDS`` words) pairs a document with the first document that holds it, so
every line gives one pair at most, however many documents share it. A shorter line does
so together with its neighbours, by the shortest runs of lines from it on and up to it
that have as many words, so each line of a repeated block is paired. The pairs are
aligned with patience diff: lines that occur once on both sides and keep their order
are anchors, anchors grow over equal neighbours, the gaps between them are aligned
alike, and what stays unmatched is aligned again, so moved blocks are found too.
Runs of matched lines with at least ``min_words`` words leave the later document.

Passages may also begin and end inside lines. Runs of ``min_words`` words, the smallest
hash of each ``SPREAD`` neighbours, pair a document with the first that holds them, and
all such runs of the later text that the earlier one holds leave it. So of each passage of
``min_words + SPREAD - 1`` words that an earlier document holds at least one run goes, and
no more than ``SPREAD - 1`` words stay at an end of it.
"""

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from ..session import cut, join_sized, to_table
from .columns import dealt_parts, few_rows, mapped, quoted, without
from .words import CHAIN, Words, mix, signed, slices, words_of

RARE_WORDS = 5
MIN_WORDS = 30
#: Passes of the alignment in which order counts, and documents of one block from which on a line's holders stay out of buckets.
PASSES, HOT_LINE = 16, 100
#: Hashes that leave a task as one block, and bytes of corpus text whose hashes meet in one bucket.
GATHER, BUCKET_BYTES = 1 << 20, 16 << 20
#: Neighbouring word runs of which one pairs documents: no passage of 50 words is without one.
SPREAD = 21
_LINE_END, _STOPS = 0x0A, np.zeros(256, bool)
_STOPS[[ord("."), ord("!"), ord("?")]] = True


def lines_of(words: Words, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines of some texts: the first word of each, its hash, and the text it is in.

    A word opens a line if it is a text's first, if a line end stands before it, or if the
    word before it ends a sentence. So each line has a word, and the bytes from its first
    word up to the next line's first word are its own; bytes before a text's first word
    belong to its first line.
    """
    n = len(words.hashes)
    if not n:
        none = np.zeros(0, np.int64)
        return none, np.zeros(0, np.uint64), none
    breaks = np.cumsum(words.lowered == _LINE_END)[words.starts]
    opens = np.zeros(n, bool)
    opens[words.first[:-1][words.counts > 0]] = True
    opens[1:] |= breaks[1:] != breaks[:-1]
    opens[1:] |= _STOPS[words.lowered[words.ends[:-1] - 1]]
    heads = np.flatnonzero(opens)
    place = np.arange(n) - np.repeat(heads, np.diff(np.append(heads, n)))
    parts = mix(words.hashes + (place.astype(np.uint64) + np.uint64(1)) * CHAIN)
    hashes = mix(np.add.reduceat(parts, heads))
    return heads, hashes, np.searchsorted(words.first, heads, "right") - 1


def runs_of(hashes: np.ndarray, sizes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of short lines with their neighbours, and the texts they are in, in order.

    From each line under ``RARE_WORDS`` words on, and up to it, the shortest run of lines
    of its text that has as many words.
    """
    short = np.flatnonzero(sizes < RARE_WORDS)
    total = np.append(0, np.cumsum(sizes, dtype=np.int64))
    stops = np.searchsorted(total, total[short] + RARE_WORDS)
    starts = np.searchsorted(total, total[short + 1] - RARE_WORDS, "right") - 1
    onward = stops <= np.searchsorted(text, text[short], "right")
    upward = starts >= np.searchsorted(text, text[short])
    spans = np.unique(np.concatenate([np.stack([short, stops], 1)[onward], np.stack([starts, short + 1], 1)[upward]]), axis=0)
    first, behind = spans[:, 0], spans[:, 1]
    runs = hashes[first]
    for i in range(1, RARE_WORDS):
        more = first + i < behind
        runs[more] = mix(runs[more] * CHAIN + hashes[first[more] + i])
    return mix(runs + (behind - first).astype(np.uint64)), text[first]


def word_runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` hashes; one value per start."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    runs, size = hashes, 1
    while size < k:
        step = min(size, k - size)
        runs, size = mix(runs[:len(runs) - step] * CHAIN + runs[step:]), size + step
    return runs


def _sliding(values: np.ndarray, k: int, best) -> np.ndarray:
    """The best of each ``k`` neighbours."""
    size = 1
    while size < k:
        step = min(size, k - size)
        values, size = best(values[:len(values) - step], values[step:]), size + step
    return values


def picked(runs: np.ndarray) -> np.ndarray:
    """The smallest of each ``SPREAD`` neighbours, or of all if they are fewer; sorted, without repeats."""
    return np.unique(_sliding(runs, min(SPREAD, len(runs)), np.minimum)) if len(runs) else runs


def _keys_in(column, picks_of: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Hashes that pair documents and the rows they are in: of lines and of short lines' runs, and of picked runs of words."""
    for low, _, data, offsets in slices(column):
        words = words_of(data, offsets)
        heads, hashes, text = lines_of(words, offsets)
        sizes = np.diff(np.append(heads, len(words.hashes))).astype(np.int32)
        runs, of_runs = runs_of(hashes, sizes, text)
        alone = sizes >= RARE_WORDS
        longer = word_runs(words.hashes, picks_of) if picks_of else words.hashes[:0]
        ends = np.maximum(words.first[:-1], words.first[1:] - picks_of + 1)
        picks = [picked(longer[i:j]) for i, j in zip(words.first[:-1].tolist(), ends.tolist())]
        yield (np.concatenate([hashes[alone], runs]), np.concatenate([text[alone], of_runs]) + low,
               np.concatenate([hashes[:0], *picks]), np.repeat(np.arange(len(picks)), [len(x) for x in picks]) + low)


def _narrow(ids: np.ndarray) -> tuple[int, bytes]:
    """Ids as their smallest and the differences to it, in as few bytes as hold them."""
    base = ids.min()
    above = ids.view(np.uint64) - base.view(np.uint64)
    return int(base), above.astype(np.min_scalar_type(above.max())).tobytes()


def _wide(base: int, n: int, data: bytes) -> np.ndarray:
    above = np.frombuffer(data, f"u{len(data) // n}").astype(np.uint64)
    return (above + np.array([base], np.int64).view(np.uint64)).view(np.int64)


def _blobs(keys: np.ndarray, ids: np.ndarray, by_words: bool, buckets: int) -> Iterator[dict]:
    """Sorted keys and their ids as one row per bucket.

    Of a key with more than ``HOT_LINE`` ids the bucket gets the smallest one and a mark; the ids are a row of their own.
    """
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    new = np.append(True, (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1]))
    keys, ids = keys[new], ids[new]
    heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    counts = np.diff(np.append(heads, len(keys)))
    many = np.flatnonzero(counts > HOT_LINE)
    for i in many.tolist():
        own = slice(heads[i], heads[i] + counts[i])
        base, data = _narrow(ids[own])
        # groups of rows that only pass through, by block
        yield {"bucket": -1 - int(ids[0]) % (1 << 30), "by_words": by_words, "keys": keys[own][:1].tobytes(), "base": base,
               "ids": data, "n": int(counts[i]), "marks": b""}
    marks, stay = keys[heads[many]], np.repeat(counts <= HOT_LINE, counts)
    stay[heads] = True
    keys, ids = keys[stay], ids[stay]
    bounds = np.array([-(-(i << 32) // buckets) << 32 for i in range(buckets)], np.uint64)
    edges, of_marks = (np.append(np.searchsorted(x, bounds), len(x)).tolist() for x in (keys, marks))
    for bucket, (i, j) in enumerate(zip(edges, edges[1:])):
        if j > i:
            base, data = _narrow(ids[i:j])
            yield {"bucket": bucket, "by_words": by_words, "keys": keys[i:j].tobytes(), "base": base, "ids": data, "n": j - i,
                   "marks": marks[of_marks[bucket]:of_marks[bucket + 1]].tobytes()}


def line_keys(docs: DataFrame, text: str, key: str, picks_of: int, buckets: int) -> DataFrame:
    """What may pair documents, as blobs of many documents by bucket: see ``_blobs``."""
    schema = "bucket int, by_words boolean, keys binary, base long, ids binary, n int, marks binary"
    types = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches):
        held, n = [], 0

        def packed():
            for by_words in (False, True):
                keys, ids = (np.concatenate([x[2 * by_words + i] for x in held]) for i in range(2))
                if len(keys):
                    yield pa.RecordBatch.from_pylist(list(_blobs(keys, ids, by_words, buckets)), schema=types)

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for lines, rows, picks, of_picks in _keys_in(batch.column(1), picks_of):
                held.append((lines, ids[rows], picks, ids[of_picks]))
                n += len(lines) + len(picks)
                if n >= GATHER:
                    yield from packed()
                    held, n = [], 0
        if held:
            yield from packed()

    given = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long"), F.col(text).cast("string"))
    return given.mapInArrow(run, schema)


PAIRED = pa.schema([("id", pa.int64()), ("first", pa.int64()), ("by_words", pa.bool_()), ("line", pa.int64()), ("held", pa.list_(pa.int64()))])


def _paired(names: tuple, table: pa.Table) -> pa.Table:
    """The pairs of one bucket, the first holders of its marked lines, and rows that pass through."""
    bucket, by_words = (x.as_py() for x in names)
    blobs = table.to_pylist()
    keys = [np.frombuffer(x["keys"], np.uint64) for x in blobs]
    ids = [_wide(x["base"], x["n"], x["ids"]) for x in blobs]
    if bucket < 0:
        return pa.Table.from_pylist([{"by_words": by_words, "line": int(signed(k)[0]), "held": i.tolist()} for k, i in zip(keys, ids)],
                                    schema=PAIRED)
    keys, ids = np.concatenate(keys), np.concatenate(ids)
    order = np.argsort(keys)
    keys, ids = keys[order], ids[order]
    heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    firsts = np.minimum.reduceat(ids, heads)
    marks = np.unique(np.concatenate([np.frombuffer(x["marks"], np.uint64) for x in blobs]))
    of_marks = firsts[np.searchsorted(keys[heads], marks)]
    first = np.repeat(firsts, np.diff(np.append(heads, len(keys))))
    later = ids > first
    ids, first = ids[later], first[later]
    order = np.lexsort((first, ids))
    ids, first = ids[order], first[order]
    new = np.append(True, (ids[1:] != ids[:-1]) | (first[1:] != first[:-1]))[:len(ids)]
    ids, first = ids[new], first[new]
    n, m = len(ids), len(marks)
    none = pa.nulls(m, pa.int64())
    return pa.Table.from_arrays([
        pa.chunked_array([pa.array(ids), none]), pa.array(np.append(first, of_marks)), pa.array(np.full(n + m, by_words)),
        pa.chunked_array([pa.nulls(n, pa.int64()), pa.array(signed(marks))]), pa.nulls(n + m, PAIRED.field("held").type)], schema=PAIRED)


def paired(docs: DataFrame, text: str = "text", key: str = "doc_id", picks_of: int = 0) -> DataFrame:
    """``(id, first, by_words)``: each document and the first ones that hold a line or a picked run of words of it."""
    size = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    blobs = line_keys(docs, text, key, picks_of, max(1, -(-size // BUCKET_BYTES)))
    found = to_table(blobs.groupBy("bucket", "by_words").applyInArrow(_paired, from_arrow_schema(PAIRED)), "paired")
    hot = found.where("id IS NULL AND held IS NULL").select("line", "by_words", "first")
    held = join_sized(found.where("held IS NOT NULL").select("line", "by_words", "held"), hot, ["line", "by_words"])
    held = held.select(F.explode("held").alias("id"), "first", "by_words").where("id > first")
    pairs = found.where("id IS NOT NULL").select("id", "first", "by_words").unionByName(held)
    return cut(pairs.groupBy("id", "first").agg(F.max("by_words").alias("by_words")))


def _ordered(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs (sorted by their first) whose seconds grow."""
    tails: list[int] = []
    ends: list[int] = []
    before = [-1] * len(pairs)
    for i, (_, y) in enumerate(pairs):
        at = bisect_left(tails, y)
        if at:
            before[i] = ends[at - 1]
        if at == len(tails):
            tails.append(y)
            ends.append(i)
        else:
            tails[at], ends[at] = y, i
    found, i = [], ends[-1] if ends else -1
    while i >= 0:
        found.append(pairs[i])
        i = before[i]
    return found[::-1]


def _anchors(a: list[int], b: list[int], places_a: list[int], places_b: list[int]) -> list[tuple[int, int]]:
    """Lines that occur once in both ranges, in an order that both share."""
    def single(lines, places):
        seen: dict[int, int] = {}
        for i in places:
            seen[lines[i]] = -1 if lines[i] in seen else i
        return seen

    here, there = single(a, places_a), single(b, places_b)
    return _ordered([(i, there[x]) for x, i in here.items() if i >= 0 and there.get(x, -1) >= 0])


def _aligned(a: list[int], b: list[int], places_a: list[int], places_b: list[int]) -> list[tuple[int, int]]:
    """Patience diff of two ranges: anchors, equal neighbours, and the gaps alike."""
    found: list[tuple[int, int]] = []
    open_ranges = [(places_a, places_b)]
    while open_ranges:
        left, right = open_ranges.pop()
        low = 0
        while low < min(len(left), len(right)) and a[left[low]] == b[right[low]]:
            found.append((left[low], right[low]))
            low += 1
        left, right = left[low:], right[low:]
        high = 0
        while high < min(len(left), len(right)) and a[left[-1 - high]] == b[right[-1 - high]]:
            found.append((left[-1 - high], right[-1 - high]))
            high += 1
        left, right = left[:len(left) - high], right[:len(right) - high]
        if not left or not right:
            continue
        anchors = _anchors(a, b, left, right)
        found.extend(anchors)
        i = j = 0
        for x, y in [*anchors, (None, None)]:
            k = len(left) if x is None else bisect_left(left, x)
            m = len(right) if y is None else bisect_left(right, y)
            if anchors and k > i and m > j:
                open_ranges.append((left[i:k], right[j:m]))
            i, j = k + 1, m + 1
    return found


def _counted(lines: list[int], places: list[int]) -> dict[tuple[int, int], int]:
    """Places by line and how often the line stood before, in order."""
    seen: Counter = Counter()
    found = {}
    for i in places:
        found[lines[i], seen[lines[i]]] = i
        seen[lines[i]] += 1
    return found


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Matched positions of two lists of lines; moved blocks are found in further passes.

    Lines in reverse would need a pass each; what is left after ``PASSES`` passes is in no common order any more, and the k-th
    of a line takes the k-th there, as the passes would in the end.
    """
    shared = set(a) & set(b)
    left = [i for i, x in enumerate(a) if x in shared]
    right = [i for i, x in enumerate(b) if x in shared]
    found: list[tuple[int, int]] = []
    turns = 0
    while left and right:
        turns += 1
        step = _aligned(a, b, left, right) if turns <= PASSES else None
        if not step:
            # no line occurs once on both sides any more: the k-th of a line takes the k-th there
            there = _counted(b, right)
            step = [(i, there[x]) for x, i in _counted(a, left).items() if x in there]
            step = _ordered(step) if turns <= PASSES else step
        if not step:
            break
        found.extend(step)
        gone_a, gone_b = {i for i, _ in step}, {j for _, j in step}
        left = [i for i in left if i not in gone_a]
        right = [j for j in right if j not in gone_b]
    return sorted(found)


def _ranges(marked: np.ndarray) -> list[tuple[int, int]]:
    """Runs of marked places: first, behind the last."""
    turns = np.diff(np.concatenate([[0], marked.astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(turns == 1).tolist(), np.flatnonzero(turns == -1).tolist()))


class _Earlier:
    """What one row of an earlier document holds."""

    def __init__(self, lines: np.ndarray, text, k: int):
        self.lines, self.known, self.k = lines, np.unique(lines), k
        self._text, self._runs = text, None

    def places(self, lines: np.ndarray) -> np.ndarray:
        """Marks of the lines that are matched."""
        if np.array_equal(lines, self.lines):
            return np.ones(len(lines), bool)
        marked = np.zeros(len(lines), bool)
        here = np.flatnonzero(_held(lines, self.known))
        if len(here):
            there = self.lines[_held(self.lines, np.unique(lines[here]))]
            marked[here[[i for i, _ in patience(lines[here].tolist(), there.tolist())]]] = True
        return marked

    def words(self, runs: np.ndarray) -> list[int]:
        """Ranges of words whose runs of ``k`` words are here."""
        if self._runs is None:
            self._runs = np.unique(next(_runs_in([self._text], self.k)))
        return [x for i, j in _ranges(_held(runs, self._runs)) for x in (i, j + self.k - 1)]


def _held(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(known):
        return np.zeros(len(values), bool)
    place = np.searchsorted(known, values)
    place[place == len(known)] = 0
    return known[place] == values


def _runs_in(texts: list, k: int) -> Iterator[np.ndarray]:
    """The hashes of all runs of ``k`` words of each text."""
    for _, _, data, offsets in slices(pa.array(texts, pa.large_string())):
        words = words_of(data, offsets)
        runs = word_runs(words.hashes, k)
        for i, j in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
            yield runs[i:max(i, j - k + 1)]


def _lines_in(batches):
    """``(id, lines, text, needs)``: the hashes of each row's lines, in order."""
    for batch in batches:
        for part in few_rows([batch]):
            found = []
            for _, _, data, offsets in slices(part.column(1)):
                _, hashes, text = lines_of(words_of(data, offsets), offsets)
                found.append((signed(hashes), np.bincount(text, minlength=len(offsets) - 1)))
            hashes, counts = (np.concatenate([x[i] for x in found]) if found else np.zeros(0, np.int64) for i in range(2))
            ends = np.append(0, np.cumsum(counts)).astype(np.int32)
            lines = pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes))
            yield pa.RecordBatch.from_arrays([part.column(0), lines, part.column(1), part.column(2)], names=["id", "lines", "text", "needs"])


def _shared(batches, k: int):
    """Ranges of lines and of words of later texts that the earlier document before them holds.

    Rows ``(first, part, later, id, lines, text)`` come sorted, so each part of a first document opens with its own rows.
    """
    at, earlier = None, []
    for batch in batches:
        firsts, parts, laters = (batch.column(i).to_pylist() for i in range(3))
        lines, texts = batch.column(4), batch.column(5)
        edges, values = lines.offsets.to_numpy(), lines.values.to_numpy(zero_copy_only=False)
        todo, kept, places = [], [], []
        for i, later in enumerate(laters):
            own = values[edges[i]:edges[i + 1]]
            if not later:
                if at != (firsts[i], parts[i]):
                    at, earlier = (firsts[i], parts[i]), []
                earlier.append(_Earlier(own, texts[i].as_py(), k))
                continue
            kept.append(i)
            places.append(np.logical_or.reduce([x.places(own) for x in earlier]))
            if texts[i].is_valid and not places[-1].all():
                todo.append((len(kept) - 1, i, earlier))
        words: list[list[int]] = [[] for _ in kept]
        runs = _runs_in([texts[i].as_py() for _, i, _ in todo], k)
        for (j, _, held), own in zip(todo, runs):
            words[j] = [x for one in held for x in one.words(own)]
        kind = pa.list_(pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column(3).take(pa.array(kept, pa.int32())), pa.array([[x for y in _ranges(p) for x in y] for p in places], kind),
             pa.array(words, kind)], names=["id", "places", "words"])


def _without(text: bytes, places: list[int], repeated: list[int], min_words: int) -> tuple[bytes, list[tuple[int, int]]]:
    """A text without the long enough runs of repeated words, and the ranges of lines that lose words."""
    data, offsets = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    words = words_of(data, offsets)
    heads, _, _ = lines_of(words, offsets)
    matched = np.zeros(len(heads), bool)
    for i, j in zip(places[::2], places[1::2]):
        matched[i:j] = True
    marked = np.repeat(matched, np.diff(np.append(heads, len(words.hashes))))
    for i, j in zip(repeated[::2], repeated[1::2]):
        marked[i:j] = True
    spans = [(i, j) for i, j in _ranges(marked) if j - i >= min_words]
    if not spans:
        return text, []
    cuts = np.append(words.starts, len(text))
    cuts[0] = 0
    edges = [0, *(int(cuts[x]) for span in spans for x in span), len(text)]
    gone = np.zeros(len(marked), bool)
    for i, j in spans:
        gone[i:j] = True
    return b"".join(text[x:y] for x, y in zip(edges[::2], edges[1::2])), _ranges(np.logical_or.reduceat(gone, heads))


def repeated_parts(docs: DataFrame, text: str = "text", key: str = "doc_id", min_words: int = MIN_WORDS,
                   within_lines: bool = True) -> DataFrame:
    """``(key, places, words)``: what later documents share with earlier ones.

    The ranges of lines (first, behind the last, first, ...), by alignment, and the ranges of words whose runs of
    ``min_words`` words are held there.
    """
    picks_of = min_words if within_lines and min_words > 0 else 0
    pairs = paired(docs, text, key, picks_of)
    parts = F.coalesce("_parts", F.lit(1))
    later = join_sized(pairs, dealt_parts(pairs, "first"), "first", "left").select(
        "id", "first", F.pmod(F.xxhash64("id"), parts).cast("int").alias("part"), F.lit(True).alias("later"), "by_words")
    earlier = later.groupBy("first", "part").agg(F.max("by_words").alias("by_words")).select(
        F.col("first").alias("id"), "first", "part", F.lit(False).alias("later"), "by_words")
    needs = cut(later.unionByName(earlier).groupBy("id").agg(
        F.collect_list(F.struct("first", "part", "later", "by_words")).alias("needs")))
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    given = join_sized(texts, needs, "id").select("id", "text", "needs")
    # texts go where runs of words are compared, lines everywhere
    moved = given.mapInArrow(_lines_in, T.StructType([
        given.schema["id"], T.StructField("lines", T.ArrayType(T.LongType())), given.schema["text"], given.schema["needs"]])).select(
        "id", "lines", "text", F.explode("needs").alias("need")).select(
        "need.first", "need.part", "need.later", "id", "lines", F.when(F.col("need.by_words"), F.col("text")).alias("text"))
    moved = moved.repartition("first", "part").sortWithinPartitions("first", "part", "later")
    found = moved.mapInArrow(lambda batches: _shared(batches, min_words), "id long, places array<int>, words array<int>")
    found = found.where("size(places) + size(words) > 0").groupBy("id").agg(
        *[F.flatten(F.collect_set(c)).alias(c) for c in ("places", "words")])
    return to_table(found.withColumnRenamed("id", key), "repeated")


def deduplicated(docs: DataFrame, text: str = "text", key: str = "doc_id", min_words: int = MIN_WORDS,
                 within_lines: bool = True) -> DataFrame:
    """All rows and columns of ``docs``, ``text`` without repeated blocks, and two columns more.

    ``n_removed`` counts the lines taken out, wholly or in part, and ``removed_spans`` holds their
    ranges ``[first, behind the last]`` of line numbers. Without ``within_lines`` only whole lines go. A document is later than another if its key
    is larger; rows that share a key, or have none, are never compared with one another. Null
    and empty texts stay. Repeats inside one document stay, as do blocks under ``min_words``
    words. A block is a run of matched lines and of repeated words; they may have been matched
    with different earlier documents. Columns of ``docs`` named
    like the new ones (or ``_places`` and ``_words``) give way to them.
    """
    docs = without(docs, "n_removed", "removed_spans", "_places", "_words")
    others = [c for c in docs.columns if c != text]
    parts = repeated_parts(docs, text, key, min_words, within_lines)
    given = join_sized(docs, parts.withColumnsRenamed({"places": "_places", "words": "_words"}), key, "left")
    spans = T.ArrayType(T.ArrayType(T.IntegerType()))
    schema = T.StructType([*(docs.schema[c] for c in others), T.StructField(text, T.StringType()),
                           T.StructField("n_removed", T.IntegerType()), T.StructField("removed_spans", spans)])

    def run(batches):
        for batch in batches:
            column, places, words = (batch.column(len(others) + i) for i in range(3))
            texts, removed = column.to_pylist(), []
            for i, (given_places, given_words) in enumerate(zip(places.to_pylist(), words.to_pylist())):
                found = []
                if (given_places or given_words) and texts[i] is not None:
                    value, found = _without(column[i].as_buffer().to_pybytes(), given_places, given_words, min_words)
                    texts[i] = value.decode() if found else texts[i]
                removed.append(found)
            texts = column if not any(removed) else pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(others)], texts, pa.array([sum(j - i for i, j in x) for x in removed], pa.int32()),
                 pa.array(removed, pa.list_(pa.list_(pa.int32())))], names=schema.names)

    cleaned = mapped(given.select(*[quoted(c) for c in others], F.col(text).cast("string"), "_places", "_words"), run, schema)
    return cleaned.select(*[quoted(c) for c in docs.columns], "n_removed", "removed_spans")


def without_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated blocks taken out; documents of which no word is left go, blank ones stay."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    done = deduplicated(docs.toDF(*names.values()), names[text], names[key], min_words)
    return done.where((F.col("n_removed") == 0) | F.col(names[text]).rlike(r"\S")).select(
        *[F.col(n).alias(c) for c, n in names.items()])
