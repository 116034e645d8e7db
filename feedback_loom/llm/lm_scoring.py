"""Language-model scores from a log-frequency Bloom filter.

The corpus's word pairs are counted and their counts quantised on a logarithmic scale; a pair
at level q goes into a Bloom filter q times, as (pair, 1) to (pair, q). A worker reads a
count by probing (pair, 1), (pair, 2), ... until a probe fails. A level stands for the
smallest count it may hold, so apart from the filter's small error rate, which can only
add levels, no read count exceeds the true one.

The probability of a word mixes the pair's relative frequency with the word's own add-one
frequency. The weight depends on the binary logarithm of the left word's count: it is the Witten-Bell
weight of all left words of that class together, tokens / (tokens + different pairs). Word
counts are exact, kept as sorted hashes.

Both word counts and pairs grow with the corpus. A model within ``MAX_BYTES`` is one broadcast and one
pass; filter blocks are written first and their bytes summed. A larger one is not broadcast: rows are gathered to chunks, each
chunk sends its different words and pairs to their buckets, and what these hold comes back to it, so texts are read a fixed
number of times however large the model is. If the words alone are too large to tell the class of each left word by
broadcast, pairs are counted in buckets of their left words, where the word counts meet them; results differ by the errors of the filter alone.
"""

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import drop_scratch, recorded_scratch, to_table, without_old_shuffles
from .words import CHAIN, mix, slices, words_of

HASHES = 6
BITS_PER_ENTRY = 10
#: Most bytes of word counts and filter that are broadcast at once.
MAX_BYTES = 256 << 20
#: Most bytes of a word's hash, count and share of the index.
WORD_BYTES = 24
#: Bytes of corpus text whose words and pairs meet in one combining task.
BUCKET_BYTES = 8 << 20
#: Tokens whose repeats are counted together before they leave a task.
GATHER = 1 << 20
#: Bytes of text of a chunk (one text at least), whose words and pairs are looked up together.
CHUNK_BYTES = 8 << 20
CLASSES = 32
END, START = np.uint64(0x5DEECE66D1234567), np.uint64(0x2545F4914F6CDD1D)
CLASS_SHIFT = np.uint64(58)


def levels(counts: np.ndarray) -> np.ndarray:
    """1 for a count of 1, 2 for 2, 3 for 3 and 4, 4 for 5 to 8, ..."""
    return 1 + np.ceil(np.log2(counts)).astype(np.int64)


def floors(level: np.ndarray) -> np.ndarray:
    """The smallest count of each level."""
    return np.where(level < 2, level, 2.0 ** (level - 2) + (level > 2) + (level == 2))


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts with one end token behind each, and where each text begins."""
    words = words_of(data, offsets)
    first = np.concatenate([[0], np.cumsum(words.counts + 1)])
    tokens = np.full(first[-1], END, np.uint64)
    keep = np.ones(first[-1], bool)
    keep[first[1:] - 1] = False
    tokens[keep] = words.hashes
    return tokens, first


def lefts_of(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The token before each one; the start mark before the first of a text."""
    left = np.empty_like(tokens)
    left[1:] = tokens[:-1]
    left[first[:-1]] = START
    return left


def gathered(column, values_of) -> Iterator[np.ndarray]:
    """``values_of(tokens, first)`` of many slices of texts, joined until there are ``GATHER`` of them."""
    parts, n = [], 0
    for _, _, data, offsets in slices(column):
        parts.append(values_of(*tokens_of(data, offsets)))
        n += len(parts[-1])
        if n >= GATHER:
            yield np.concatenate(parts)
            parts, n = [], 0
    if n:
        yield np.concatenate(parts)


def bucket_of(tokens: np.ndarray, buckets: int) -> np.ndarray:
    """Equal ranges of the hashes, so buckets in order hold sorted hashes."""
    return ((tokens >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


class Words:
    """Exact counts of the words of some shards, found by the leading bits of their hashes."""

    def __init__(self, sizes: dict[int, int], rows):
        begin, at = {}, 0
        for bucket in sorted(sizes):
            begin[bucket], at = at, at + sizes[bucket]
        self.hashes = np.full(at + 1, 2 ** 64 - 1, np.uint64)
        self.counts = np.zeros(at + 1, np.int64)
        for row in rows:
            part = slice(begin[row["bucket"]], begin[row["bucket"]] + sizes[row["bucket"]])
            self.hashes[part] = np.frombuffer(row["keys"], np.uint64)
            self.counts[part] = np.frombuffer(row["counts"], np.int64)
        bits = max(1, min(24, len(self.hashes).bit_length() - 1))
        self.shift = np.uint64(64 - bits)
        self.start = np.searchsorted(self.hashes, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)

    def of(self, tokens: np.ndarray) -> np.ndarray:
        at = self.start[tokens >> self.shift]
        late = np.flatnonzero(self.hashes[at] < tokens)
        while len(late):
            at[late] += 1
            late = late[self.hashes[at[late]] < tokens[late]]
        return np.where(self.hashes[at] == tokens, self.counts[at], 0)


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """58-bit hashes of pairs; the upper bits are free for the class of the left word."""
    return mix(mix(left * CHAIN) + right) >> np.uint64(64 - 58)


def class_of(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(counts, 1)).astype(np.int64), CLASSES - 1)


def positions(keys: np.ndarray, level: int, number: int, size) -> np.ndarray:
    spread = mix(keys + np.array([level * HASHES + number + 1], np.uint64) * CHAIN)
    return ((spread >> np.uint64(32)) * size >> np.uint64(32)).astype(np.int64)


def filter_block(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """The Bloom filter of one bucket, sized by its entries."""
    level = levels(counts)
    size = max(64, -(-int(level.sum()) * BITS_PER_ENTRY // 8) * 8)
    bits = np.zeros(size, bool)
    for q in range(1, int(level.max()) + 1):
        keys, level = keys[level >= q], level[level >= q]
        for h in range(HASHES):
            bits[positions(keys, q, h, np.uint64(size))] = True
    return np.packbits(bits, bitorder="little").tobytes()


class Filter:
    """The blocks of one cell."""

    def __init__(self, size: int, rows, buckets: int):
        self.bits = np.zeros(size, np.uint8)
        self.start, self.size = np.zeros(buckets, np.int64), np.zeros(buckets, np.uint64)
        at = 0
        for row in rows:
            block = np.frombuffer(row["block"], np.uint8)
            self.bits[at:at + len(block)] = block
            self.start[row["bucket"]], self.size[row["bucket"]] = at * 8, len(block) * 8
            at += len(block)

    def level(self, keys: np.ndarray) -> np.ndarray:
        """Probe (key, 1), (key, 2), ... until one is missing."""
        found = np.zeros(len(keys), np.int64)
        bucket = (keys % np.uint64(len(self.start))).astype(np.int64)
        start, size = self.start[bucket], self.size[bucket]
        at = np.flatnonzero(size > 0)
        q = 1
        while len(at):
            for h in range(HASHES):
                bit = start[at] + positions(keys[at], q, h, size[at])
                at = at[(self.bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1]
            found[at] = q
            q += 1
        return found


@dataclass
class Deal:
    """The block of each pair: any by its own hash, or one of those of its left word's bucket."""

    buckets: int
    #: Blocks of each bucket of left words, the more the more tokens it has; none if left words do not matter.
    parts: list[int] = field(default_factory=list)

    def block_of(self, left: np.ndarray, keys: np.ndarray) -> np.ndarray:
        if not self.parts:
            return (keys % np.uint64(self.buckets)).astype(np.int64)
        parts = np.array(self.parts, np.uint64)
        start, bucket = np.cumsum(parts) - parts, bucket_of(left, self.buckets)
        return (start[bucket] + keys % parts[bucket]).astype(np.int64)


@dataclass
class Model:
    """Tables of the counts in the shared folder, and a few numbers. More than one shard: too large to be broadcast."""

    words: DataFrame
    blocks: DataFrame
    tokens: int
    vocabulary: int
    documents: int
    shards: int
    buckets: int
    weights: list[float]
    deal: Deal


def _blobs(names: list[str], columns: tuple, keys: np.ndarray, counts: np.ndarray, bucket: np.ndarray):
    """Sorted keys and counts as one row of bytes per bucket; counts of one slice of texts fit 32 bits, sums are 64 bits wide."""
    order = np.argsort(bucket, kind="stable")
    keys, counts, bucket = keys[order], counts[order].astype(np.uint32), bucket[order]
    edges = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
    ends = np.append(edges[1:], len(bucket))
    return pa.RecordBatch.from_arrays(
        [*(pa.array(np.full(len(edges), c, np.int32)) for c in columns), pa.array(bucket[edges].astype(np.int32)),
         pa.array([keys[a:b].tobytes() for a, b in zip(edges, ends)], pa.binary()),
         pa.array([counts[a:b].tobytes() for a, b in zip(edges, ends)], pa.binary())], names=names)


def _summed(parts: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([np.frombuffer(a, np.uint64) for a, _ in parts])
    counts = np.concatenate([np.frombuffer(b, np.uint32) for _, b in parts]).astype(np.int64)
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    edges = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[edges], np.add.reduceat(counts, edges)


def _combined(blobs: DataFrame, by: list[str], each, schema: str) -> DataFrame:
    """One result row per bucket; a bucket's size is that of ``BUCKET_BYTES`` of text."""
    types = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(table: pa.Table) -> pa.Table:
        parts = [(a.as_py(), b.as_py()) for a, b in zip(table.column("keys"), table.column("counts"))]
        head = [table.column(c)[0].as_py() for c in by]
        return pa.Table.from_pylist([dict(zip(by, head)) | each(*_summed(parts))], schema=types)

    return blobs.groupBy(*by).applyInArrow(run, schema)


def trained(texts: DataFrame, text: str = "text", max_bytes: int = MAX_BYTES) -> Model:
    """Count words and pairs of all rows of ``texts`` and put the pairs into filter blocks; null texts count as empty."""
    spark = texts.sparkSession
    source = texts.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(4, -(-size // BUCKET_BYTES))

    def words(batches):
        for batch in batches:
            for tokens in gathered(batch.column(0), lambda tokens, first: tokens):
                keys, counts = np.unique(tokens, return_counts=True)
                yield _blobs(["bucket", "keys", "counts"], (), keys, counts, bucket_of(keys, buckets))

    with without_old_shuffles(spark):
        counted = to_table(_combined(
            source.mapInArrow(words, "bucket int, keys binary, counts binary"), ["bucket"],
            lambda keys, counts: {"keys": keys.tobytes(), "counts": counts.astype(np.int64).tobytes(), "tokens": int(counts.sum()),
                                  "ends": int(counts[keys == END].sum()), "words": len(keys)},
            "bucket int, keys binary, counts binary, tokens long, ends long, words long"), "words")
        tokens, ends, vocabulary = (x or 0 for x in counted.agg(F.sum("tokens"), F.sum("ends"), F.sum("words")).first())
        if vocabulary * WORD_BYTES <= max_bytes:
            deal = Deal(buckets)
            blocks = _pair_blocks(spark, source, counted, ends, deal)
        else:
            deal = Deal(buckets, _parts(counted, tokens, ends, buckets))
            blocks = _pair_blocks_by_left(spark, source, counted, ends, deal)
    shards = _shards(counted, blocks, buckets, max_bytes)
    blocks = blocks.withColumns({"one": F.pmod("bucket", F.lit(shards)),
                                 "two": F.pmod(F.floor(F.col("bucket") / shards).cast("int"), F.lit(shards))})
    sums = [F.sum(F.col(c)[i]).alias(f"{c}{i}") for c in ("pairs", "seen") for i in range(CLASSES)]
    row = blocks.agg(*sums).first()
    weights = [(row[f"seen{i}"] or 0) / max(1, (row[f"seen{i}"] or 0) + (row[f"pairs{i}"] or 0)) for i in range(CLASSES)]
    return Model(counted, blocks, tokens, vocabulary, ends, shards, buckets, weights, deal)


def _shards(counted: DataFrame, blocks: DataFrame, buckets: int, max_bytes: int) -> int:
    """The fewest shards whose largest cell is within the bound as it is broadcast: blocks (one, two) and words of these shards."""
    words, filters = np.zeros(buckets, np.int64), np.zeros(0, np.int64)
    for row in counted.select("bucket", "words").collect():  # one row per bucket, here and below
        words[row["bucket"]] = row["words"] * WORD_BYTES
    if sizes := blocks.select("bucket", F.length("block")).collect():
        filters = np.zeros(1 + max(bucket for bucket, _ in sizes), np.int64)
        filters[[bucket for bucket, _ in sizes]] = [size for _, size in sizes]
    shards = 1
    while True:
        of_words = np.bincount(np.arange(buckets) % shards, words, shards)
        both = of_words[:, None] + of_words[None, :]
        np.fill_diagonal(both, of_words)
        place = np.arange(len(filters))
        cells = np.bincount(place % shards * shards + place // shards % shards, filters, shards ** 2)
        most = (cells + both.ravel()).max() + 16 * buckets
        if most <= max_bytes or shards >= buckets:
            return shards
        shards = min(buckets, max(shards + 1, int(shards * (most / max_bytes) ** 0.5)))


BLOCKS = "bucket int, block binary, pairs array<long>, seen array<long>"


def _block(keys: np.ndarray, counts: np.ndarray, kinds: np.ndarray) -> dict:
    return {"block": filter_block(keys, counts), "pairs": np.bincount(kinds, minlength=CLASSES).tolist(),
            "seen": np.bincount(kinds, counts, CLASSES).astype(np.int64).tolist()}


def _pair_blocks(spark, source: DataFrame, counted: DataFrame, ends: int, deal: Deal) -> DataFrame:
    """The filter blocks, written; all words are broadcast, so that a pair has its left word's class with it."""
    held = _broadcast_words(spark, counted, 0, 0, 1)

    def keys_of(right, first):
        left = lefts_of(right, first)
        of_left = held.value.of(left)
        of_left[left == START] = ends
        return pair_keys(left, right) | (class_of(of_left).astype(np.uint64) << CLASS_SHIFT)

    def pairs(batches):
        for batch in batches:
            for keys in gathered(batch.column(0), keys_of):
                keys, counts = np.unique(keys, return_counts=True)
                bare = keys & np.uint64((1 << 58) - 1)
                yield _blobs(["bucket", "keys", "counts"], (), keys, counts, deal.block_of(bare, bare))

    def block(keys, counts):
        return _block(keys & np.uint64((1 << 58) - 1), counts, (keys >> CLASS_SHIFT).astype(np.int64))

    found = to_table(_combined(source.mapInArrow(pairs, "bucket int, keys binary, counts binary"), ["bucket"], block, BLOCKS), "blocks")
    held.destroy()
    return found


def _parts(counted: DataFrame, tokens: int, ends: int, buckets: int) -> list[int]:
    """Blocks for the pairs of each bucket of left words, so that a word that is very common has many; one row per bucket is read."""
    sizes = np.zeros(buckets, np.int64)
    for row in counted.select("bucket", "tokens").collect():
        sizes[row["bucket"]] = row["tokens"]
    sizes[bucket_of(np.array([START]), buckets)] += ends
    each = max(1, -(-tokens // buckets))
    return np.maximum(1, -(-sizes // each)).tolist()


def _pair_blocks_by_left(spark, source: DataFrame, counted: DataFrame, ends: int, deal: Deal) -> DataFrame:
    """The filter blocks, written; pairs are dealt by their left words and meet the counts of these in their block's task."""
    schema = "bucket int, lefts binary, runs binary, keys binary, counts binary"
    binary = pa.binary()

    def pairs(batches):
        for batch in batches:
            # left words and pairs, one below the other
            for both in gathered(batch.column(0), lambda right, first: np.stack([left := lefts_of(right, first), pair_keys(left, right)], 1)):
                keys, at, number = _distinct(both[:, 1])
                left, counts = both[at, 0], np.bincount(number)
                block = deal.block_of(left, keys)
                order = np.lexsort((left, block))
                block, left, keys, counts = block[order], left[order], keys[order], counts[order].astype(np.uint32)
                new = np.append(True, block[1:] != block[:-1])
                runs = np.flatnonzero(np.append(True, (left[1:] != left[:-1]) | new[1:]))
                lengths = np.diff(np.append(runs, len(left))).astype(np.uint32)
                edges = np.flatnonzero(new)
                ends_ = np.append(edges[1:], len(block))
                cuts = np.searchsorted(runs, np.append(edges, len(block)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block[edges].astype(np.int32)),
                     pa.array([left[runs[a:b]].tobytes() for a, b in zip(cuts, cuts[1:])], binary),
                     pa.array([lengths[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], binary),
                     pa.array([keys[a:b].tobytes() for a, b in zip(edges, ends_)], binary),
                     pa.array([counts[a:b].tobytes() for a, b in zip(edges, ends_)], binary)],
                    names=["bucket", "lefts", "runs", "keys", "counts"])

    starts = np.cumsum([0, *deal.parts]).tolist()
    spans = spark.createDataFrame([(i, a, b - 1) for i, (a, b) in enumerate(zip(starts, starts[1:]))], "of int, first int, last int")
    none = F.lit(None).cast("binary")
    known = counted.join(F.broadcast(spans), counted["bucket"] == spans["of"]).select(
        F.explode(F.sequence("first", "last")).alias("bucket"), none.alias("lefts"), none.alias("runs"), "keys", "counts")
    types = to_arrow_schema(T.StructType.fromDDL(BLOCKS))

    def run(table: pa.Table) -> pa.Table:
        words = counts_of_words = np.zeros(0, np.uint64)
        parts = []
        for row in table.to_pylist():
            if row["lefts"] is None:
                words, counts_of_words = np.frombuffer(row["keys"], np.uint64), np.frombuffer(row["counts"], np.int64)
            else:
                left = np.repeat(np.frombuffer(row["lefts"], np.uint64), np.frombuffer(row["runs"], np.uint32))
                parts.append((left, np.frombuffer(row["keys"], np.uint64), np.frombuffer(row["counts"], np.uint32)))
        if not parts:
            return types.empty_table()
        left, keys, counts = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(keys)
        left, keys, counts = left[order], keys[order], counts[order].astype(np.int64)
        edges = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        left, keys, counts = left[edges], keys[edges], np.add.reduceat(counts, edges)
        of_left = np.full(len(left), ends, np.int64)
        inner = left != START
        of_left[inner] = counts_of_words[np.searchsorted(words, left[inner])]
        return pa.Table.from_pylist([{"bucket": table.column("bucket")[0].as_py()} | _block(keys, counts, class_of(of_left))], schema=types)

    return to_table(source.mapInArrow(pairs, schema).unionByName(known).groupBy("bucket").applyInArrow(run, BLOCKS), "blocks")


def _broadcast_words(spark, counted: DataFrame, one: int, two: int, shards: int):
    """The word counts of two shards; a bucket's words are sorted, and so are the buckets."""
    rows = counted.where(F.pmod("bucket", F.lit(shards)).isin(one, two))
    sizes = dict(rows.select("bucket", "words").collect())  # one row per bucket
    return spark.sparkContext.broadcast(Words(sizes, rows.select("bucket", "keys", "counts").toLocalIterator()))


def _broadcast_filter(spark, blocks: DataFrame, one: int, two: int, buckets: int):
    rows = blocks.where((F.col("one") == one) & (F.col("two") == two))
    size = rows.agg(F.sum(F.length("block"))).first()[0] or 0
    return spark.sparkContext.broadcast(Filter(size, rows.select("bucket", "block").toLocalIterator(), buckets))


def scored(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id", extra: dict[str, Column] | None = None) -> DataFrame:
    """``(key, extra columns, n_tokens, n_known, base_score, score)`` for each row of ``docs``, written once.

    Scores are log10 probabilities of the whole text with its end. Null texts count as empty
    (one token); keys may repeat or be null; an empty model gives unseen words only.
    """
    spark = docs.sparkSession
    extra = extra or {}
    sums = ["n_tokens", "n_known", "base_score", "score"]
    given = docs.select(F.col(key).cast("long").alias(key), *(c.alias(n) for n, c in extra.items()),
                        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    if model.shards == 1:
        return _cell_scores(given, model).select(key, *extra, *sums)
    return _looked_up_scores(given, model).select(key, *extra, *sums)


class Scorer:
    """The log probabilities of texts, from the counts of their tokens and the levels of their pairs."""

    def __init__(self, model: Model):
        self.unseen = float(model.tokens + model.vocabulary + 1)
        self.starts, self.weights = model.documents, np.array(model.weights)

    def of_left(self, left: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return np.where(left == START, self.starts, counts)

    def sums(self, first: np.ndarray, known: np.ndarray, of_left: np.ndarray, level: np.ndarray) -> tuple:
        n = len(first) - 1
        row = np.repeat(np.arange(n), np.diff(first))
        own = (known + 1.0) / self.unseen
        weight = np.where(of_left > 0, self.weights[class_of(of_left)], 0.0)
        read = np.minimum(floors(level), of_left) / np.maximum(of_left, 1)
        return (np.bincount(row, minlength=n), np.bincount(row, known > 0, n),
                np.bincount(row, np.log10(own), n), np.bincount(row, np.log10(weight * read + (1 - weight) * own), n))


def _scores_schema(given: DataFrame) -> tuple[list[str], T.StructType]:
    names = [c for c in given.columns if c != "_text"]
    return names, T.StructType([*(given.schema[c] for c in names), T.StructField("n_tokens", T.LongType()),
                                T.StructField("n_known", T.LongType()), T.StructField("base_score", T.DoubleType()),
                                T.StructField("score", T.DoubleType())])


def _sum_columns(found: list[tuple]) -> list[pa.Array]:
    columns = [np.concatenate([f[i] for f in found]) if found else np.zeros(0) for i in range(4)]
    return [*(pa.array(c.astype(np.int64)) for c in columns[:2]), *(pa.array(c.astype(np.float64)) for c in columns[2:])]


def _cell_scores(given: DataFrame, model: Model) -> DataFrame:
    """The scores by a model that is broadcast whole. Written before they are returned, so the broadcasts can go."""
    spark = given.sparkSession
    scorer = Scorer(model)
    cell = _broadcast_filter(spark, model.blocks, 0, 0, model.buckets)
    words = _broadcast_words(spark, model.words, 0, 0, 1)
    names, schema = _scores_schema(given)

    def each(column) -> Iterator[tuple]:
        for _, _, data, offsets in slices(column):
            right, first = tokens_of(data, offsets)
            left = lefts_of(right, first)
            known, of_left = words.value.of(right), scorer.of_left(left, words.value.of(left))
            level = np.zeros(len(right), np.int64)
            seen = np.flatnonzero((known > 0) & (of_left > 0))
            level[seen] = cell.value.level(pair_keys(left[seen], right[seen]))
            yield scorer.sums(first, known, of_left, level)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], *_sum_columns(list(each(batch.column(len(names)))))], names=schema.names)

    done = to_table(given.select(*names, "_text").mapInArrow(run, schema), "scores")
    cell.destroy()
    words.destroy()
    return done


def _packed(batch: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as out:
        out.write_table(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all()


def _chunks(given: DataFrame) -> DataFrame:
    """``(chunk, rows)``: runs of rows with ``CHUNK_BYTES`` of text as bytes, written, so that a chunk is the same to all who read it."""
    def run(batches):
        begin, n, parts, held = TaskContext.get().partitionId() << 32, 0, [], 0

        def chunk():
            return pa.RecordBatch.from_arrays([pa.array([begin + n], pa.int64()), pa.array([_packed(pa.Table.from_batches(parts))], pa.binary())],
                                              names=["chunk", "rows"])

        for batch in batches:
            for a, b, data, _ in slices(batch.column(batch.num_columns - 1)):
                if parts and held + len(data) > CHUNK_BYTES:
                    yield chunk()
                    n, parts, held = n + 1, [], 0
                parts.append(batch.slice(a, b - a))
                held += len(data)
        if parts:
            yield chunk()

    return to_table(given.mapInArrow(run, "chunk long, rows binary"), "chunks")


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different values in order, a place of each, and each value's number among them."""
    order = np.argsort(values)
    placed = values[order]
    new = np.append(True, placed[1:] != placed[:-1])[:len(values)]
    number = np.empty(len(values), np.int64)
    number[order] = np.cumsum(new) - 1
    return placed[new], order[new], number


def _narrow(keys: np.ndarray) -> bytes:
    """Keys in order as their differences, byte by byte of all of them, so that the many zeros compress."""
    return np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _wide(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


#: What is looked up.
WORD, PAIR = 0, 1


@dataclass
class Tokens:
    """The tokens of a chunk, and its different words and pairs in the order of their buckets."""

    left: np.ndarray
    right: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, rows: pa.Table) -> "Tokens":
        # a slice at a time, as finding words takes many times the bytes of a text
        parts = [tokens_of(data, offsets) for _, _, data, offsets in slices(rows.column("_text"))]
        right = np.concatenate([tokens for tokens, _ in parts])
        first = np.append(0, np.cumsum(np.concatenate([np.diff(first) for _, first in parts])))
        return cls(lefts_of(right, first), right, first)

    def words(self, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words, their buckets and each token's place among them."""
        words, _, at = _distinct(self.right)
        return words, bucket_of(words, buckets), at

    def pairs(self, deal: Deal) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs, their blocks and each token's place among them."""
        keys, index, at = _distinct(pair_keys(self.left, self.right))
        block = deal.block_of(self.left[index], keys)
        order = np.argsort(block, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        return keys[order], block[order], place[at]


def _looked_up_scores(given: DataFrame, model: Model) -> DataFrame:
    """The scores by a model of any size. Written before they are returned.

    Each chunk asks a bucket once for each of its words or pairs in it; the answers are as many numbers in the same
    order. A bucket meets all that is asked of it in one group, whose size is that of its own share of the text.
    """
    spark = given.sparkSession
    scorer, buckets, deal = Scorer(model), model.buckets, model.deal
    names, schema = _scores_schema(given)
    result = to_arrow_schema(schema)
    asked_schema, said_schema = "kind int, bucket int, chunk long, keys binary, held binary", "chunk long, kind int, bucket int, said binary"
    said_types = to_arrow_schema(T.StructType.fromDDL(said_schema))

    def ask(batches):
        for batch in batches:
            for chunk, rows in zip(batch.column(0).to_pylist(), batch.column(1)):
                tokens = Tokens.of(_unpacked(rows.as_py()))
                for kind, (keys, bucket, _) in ((WORD, tokens.words(buckets)), (PAIR, tokens.pairs(deal))):
                    edges = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
                    blobs = [_narrow(keys[a:b]) for a, b in zip(edges, np.append(edges[1:], len(keys)))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(edges), kind, np.int32)), pa.array(bucket[edges].astype(np.int32)),
                         pa.array(np.full(len(edges), chunk, np.int64)), pa.array(blobs, pa.binary()), pa.nulls(len(edges), pa.binary())],
                        names=["kind", "bucket", "chunk", "keys", "held"])

    def answer(table: pa.Table) -> pa.Table:
        kind, bucket = table.column("kind")[0].as_py(), table.column("bucket")[0].as_py()
        asked, held = [], None
        for row in table.select(["chunk", "keys", "held"]).to_pylist():
            if row["held"] is None:
                asked.append((row["chunk"], _wide(row["keys"])))
            else:
                held = row
        if held is None or not asked:
            return said_types.empty_table()  # no answer: zeros
        keys = np.concatenate([k for _, k in asked])
        if kind == WORD:
            words, counts = np.frombuffer(held["keys"], np.uint64), np.frombuffer(held["held"], np.int64)
            at = np.minimum(np.searchsorted(words, keys), len(words) - 1)
            found = np.where(words[at] == keys, counts[at], 0)
            found = found.astype(np.uint32 if found.max() < 1 << 32 else np.int64)
        else:
            found = Filter(len(held["held"]), [{"bucket": 0, "block": held["held"]}], 1).level(keys).astype(np.uint8)
        ends = np.cumsum([len(k) for _, k in asked])
        n = len(asked)
        return pa.Table.from_arrays(
            [pa.array([c for c, _ in asked], pa.int64()), pa.array(np.full(n, kind, np.int32)), pa.array(np.full(n, bucket, np.int32)),
             pa.array([part.tobytes() for part in np.split(found, ends[:-1])], pa.binary())], schema=said_types)

    def filled(said: dict[int, bytes], bucket: np.ndarray) -> np.ndarray:
        out = np.zeros(len(bucket), np.int64)
        edges = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        for a, b in zip(edges, np.append(edges[1:], len(bucket))):
            if blob := said.get(int(bucket[a])):
                out[a:b] = np.frombuffer(blob, {1: np.uint8, 4: np.uint32, 8: np.int64}[len(blob) // (b - a)])
        return out

    def score(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        said: tuple[dict, dict] = {}, {}
        for row in answers.select(["kind", "bucket", "said"]).to_pylist():
            said[row["kind"]][row["bucket"]] = row["said"]
        rows = _unpacked(chunk.column("rows")[0].as_py())
        tokens = Tokens.of(rows)
        words, bucket, at = tokens.words(buckets)
        known = filled(said[WORD], bucket)[at]
        _, block, at = tokens.pairs(deal)
        before = np.zeros_like(known)
        before[1:] = known[:-1]
        of_left = scorer.of_left(tokens.left, before)
        level = np.where((known > 0) & (of_left > 0), filled(said[PAIR], block)[at], 0)
        sums = _sum_columns([scorer.sums(tokens.first, known, of_left, level)])
        return pa.Table.from_arrays([*(rows.column(c) for c in names), *sums], names=schema.names).cast(result)

    none = F.lit(None).cast("binary")
    tables = model.words.select(F.lit(WORD).alias("kind"), "bucket", F.lit(-1).cast("long").alias("chunk"), "keys", F.col("counts").alias("held")).unionByName(
        model.blocks.select(F.lit(PAIR).alias("kind"), "bucket", F.lit(-1).cast("long").alias("chunk"), none.alias("keys"), F.col("block").alias("held")))
    with without_old_shuffles(spark), recorded_scratch() as paths:
        chunks = _chunks(given.select(*names, "_text"))
        said = chunks.mapInArrow(ask, asked_schema).unionByName(tables).groupBy("kind", "bucket").applyInArrow(answer, said_schema)
        done = to_table(chunks.groupBy("chunk").cogroup(said.groupBy("chunk")).applyInArrow(score, schema), "scores")
    drop_scratch(spark, paths[:1])  # the chunks
    return done
