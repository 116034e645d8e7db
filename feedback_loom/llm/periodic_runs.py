"""Periodic runs inside texts by seeds and their extension along diagonals.

A run is a maximal stretch of words with smallest period ``q`` (words ``q`` apart are
equal) and at least ``max(LEAST, REPEATS * q)`` words. On the diagonal of lag ``q`` (word i
against word i + q) it is a stretch of ``length - q`` equal places, so at least
``max(LEAST - q, 2 * q)`` of them: 16 for every lag, ``k`` for lags of ``k / 2`` and more. Seeds
are therefore k-grams of words, with k = 16 for lags below 16, 32 for lags from 16 to
31, and so on, doubling. A k-gram is longer than the lags of its level, so inside a run its next
occurrence lies exactly one smallest period ahead: pairs of neighbouring occurrences find every
run, and no word that occurs very often hands out all its pairs. A k-gram can only repeat
where its first half does, so each level looks at what repeated on the last one alone.

Every seed is extended on its diagonal to both sides, as far as the words agree. A table keeps how
far each lag is covered; seeds within a covered stretch are not extended again. A stretch that begins
at a next occurrence has no smaller period, as that would have been the nearer occurrence.

Words are 64-bit hashes mixed with the number of their text, so a slice of many texts is worked on
as one sequence and no run crosses from one text into the next.
"""

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .columns import mapped, quoted, without
from .words import CHAIN, mix, slices, words_of

#: Fewest words of a run, and fewest repeats of its period.
LEAST, REPEATS = 24, 3
#: Shortest overlap that every run has on its diagonal: the least of max(LEAST - q, 2 * q).
SEED = 16
RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])


def _first_difference(marks: np.ndarray, place: int, lag: int, step: int) -> int:
    """The first place from ``place`` on, in steps of 1 or -1, that differs from the place ``lag`` ahead."""
    span = 64
    while True:
        if step > 0:
            stop = min(place + span, len(marks) - lag)
            unequal = np.flatnonzero(marks[place:stop] != marks[place + lag:stop + lag])
            if len(unequal) or stop == len(marks) - lag:
                return place + int(unequal[0]) if len(unequal) else stop
            place = stop
        else:
            start = max(place - span + 1, 0)
            unequal = np.flatnonzero(marks[start:place + 1] != marks[start + lag:place + 1 + lag])
            if len(unequal) or start == 0:
                return start + int(unequal[-1]) if len(unequal) else -1
            place = start - 1
        span *= 2


def periodic_runs(marks: np.ndarray) -> np.ndarray:
    """``(start, length, period)`` of all runs of a sequence, by start, then period."""
    grams, size = marks, 1
    while size < SEED and len(grams) > size:
        grams, size = mix(grams[:-size] * CHAIN + grams[size:]), size * 2
    found = []
    alive, low = np.arange(len(grams)), 1
    while size >= SEED and len(alive) > 1:
        values = grams[alive]
        order = np.argsort(values, kind="stable")
        values = values[order]
        again = np.flatnonzero(values[1:] == values[:-1])
        here, there = alive[order[again]], alive[order[again + 1]]
        lag = there - here
        seeds = np.flatnonzero((lag >= low) & (lag < size))
        seeds = seeds[np.lexsort((here[seeds], lag[seeds]))]
        if len(seeds):
            lags, places = lag[seeds], here[seeds]
            opens = np.append(True, (np.diff(lags) != 0) | (np.diff(places) != 1))
            closes = np.append(opens[1:], True)
            covered: dict[int, int] = {}
            for q, first, last in zip(lags[opens].tolist(), places[opens].tolist(), places[closes].tolist()):
                if first < covered.get(q, 0):
                    continue
                stop = _first_difference(marks, last + size, q, 1) if last + size < len(marks) - q else last + size
                start = _first_difference(marks, first - 1, q, -1) + 1 if first else 0
                covered[q] = stop
                if stop + q - start >= max(LEAST, REPEATS * q):
                    found.append((start, stop + q - start, q))
        alive = np.unique(np.concatenate([here, there]))
        if len(grams) <= size:
            break
        grams = mix(grams[:-size] * CHAIN + grams[size:])
        low, size = size, size * 2
        alive = alive[alive < len(grams)]
    found = np.array(found, np.int64).reshape(-1, 3)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _searched(column) -> Iterator[tuple[int, list[tuple[int, int, int]], str]]:
    """Number of words, runs, and the text without repeats of each row."""
    for _, _, data, offsets in slices(column):
        words = words_of(data, offsets, lower=False)
        text_of = np.repeat(np.arange(len(offsets) - 1, dtype=np.uint64), words.counts)
        long = np.repeat(words.counts >= LEAST, words.counts)
        place = np.flatnonzero(long)
        # shorter texts hold no run and are left out
        runs = periodic_runs(mix(words.hashes[place] + text_of[place] * CHAIN))
        runs[:, 0] = place[runs[:, 0]] if len(runs) else runs[:, 0]
        owner = np.searchsorted(words.first, runs[:, 0], "right") - 1
        change = np.zeros(len(words.hashes) + 1, np.int64)
        np.add.at(change, runs[:, 0] + runs[:, 2], 1)
        np.add.at(change, runs[:, 0] + runs[:, 1], -1)
        kept = np.cumsum(change[:-1]) == 0
        low, high = np.searchsorted(owner, [np.arange(len(offsets) - 1), np.arange(1, len(offsets))])
        for row in range(len(offsets) - 1):
            a, b = int(words.first[row]), int(words.first[row + 1])
            parts = data[offsets[row]:offsets[row + 1]].tobytes().split()
            own = runs[low[row]:high[row]] - [a, 0, 0]
            if len(own):
                parts = compress(parts, kept[a:b].tolist())
            yield b - a, [tuple(r) for r in own.tolist()], b" ".join(parts).decode()


def with_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with ``n_words``, ``runs`` and ``collapsed``.

    ``runs`` lists every run as (start, length, period), words counted from 0, by start, then period.
    ``collapsed`` holds the words that are in no run after its first period, joined by one blank. Null
    and blank texts have no words and no run, and an empty ``collapsed``. Columns of ``docs`` with these names
    give way to the new ones; repeated rows are worked on alike, and an empty table stays empty. Case counts.
    """
    rest = without(docs, "n_words", "runs", "collapsed")
    at = next(i for i, c in enumerate(rest.columns) if c.lower() == text.lower())
    added = T.StructType().add("n_words", T.LongType()).add("runs", T.ArrayType(RUN)).add("collapsed", T.StringType())
    schema = T.StructType(rest.schema.fields + added.fields)
    struct = pa.list_(pa.struct([(n, pa.int64()) for n in RUN.names]))

    def run(batches):
        for batch in batches:
            n, runs, texts = list(zip(*_searched(batch.column(at)))) or ((), (), ())
            listed = [[{"start": s, "length": m, "period": q} for s, m, q in r] for r in runs]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(n, pa.int64()), pa.array(listed, struct), pa.array(texts, pa.string())],
                names=schema.names)

    return mapped(rest, run, schema)


def strongest(runs: Column) -> Column:
    """The run with the greatest exact quotient of length and period; of equal ones the first. Null without runs."""
    return F.reduce(runs, F.lit(None).cast(RUN), lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))


def listing(runs: Column) -> Column:
    """Every run as a line ``start,length,period``."""
    return F.concat_ws("", F.transform(runs, lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))


def with_planted_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with the texts of every tenth key (by crc32) made periodic from some word on.

    With h = crc32 of the key as text and g = h div 10, the words from place a = g % n on repeat the
    p = 1 + (n - a) div (3 + g % 8) words from there; chosen texts become their words joined by one blank.
    Null keys and texts without words stay as they are.
    """
    column = F.col(quoted(text))
    h = F.crc32(F.col(quoted(key)).cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = "_words"
    while words in docs.columns:
        words += "_"
    found = docs.withColumn(words, F.when(h % 10 == 0, F.regexp_extract_all(column, F.lit(r"[^ \x09-\x0D]+"), F.lit(0))))
    w, n = F.col(words), F.size(words)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    tail = F.flatten(F.array_repeat(F.slice(w, a + 1, p), F.ceil((n - a) / p).cast("int")))
    repeated = F.array_join(F.concat(F.slice(w, F.lit(1), a), F.slice(tail, F.lit(1), n - a)), " ")
    return found.withColumn(text, F.when(n > 0, repeated).otherwise(column)).drop(words)
