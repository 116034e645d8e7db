"""Words and word shingles of whole texts as 64-bit hashes, vectorised over Arrow batches.

Texts are read as UTF-8 bytes, ASCII letters lower-cased; a word is a maximal run
of bytes that are no separators and never crosses from one text into the next.
Null texts count as empty. Hashes depend on the bytes alone, so they are equal on
every machine. Work goes on in slices of about a megabyte of text; a text is never
cut, so a slice holds one whole text at least.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Fixed separators: the blank and the control characters 9 to 13.
BLANKS = np.zeros(256, bool)
BLANKS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Fixed separators: ASCII characters that are neither digits nor lower-case letters.
NO_LETTERS = np.zeros(256, bool)
NO_LETTERS[0x00:0x30] = NO_LETTERS[0x3A:0x61] = NO_LETTERS[0x7B:0x80] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

SLICE_BYTES = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
CHAIN = np.uint64(0xD6E8FEB86659FD93)
_powers = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        grown = np.full(max(n, 64), BASE, np.uint64)
        grown[0] = 1
        _powers = np.cumprod(grown, dtype=np.uint64)
    return _powers


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(column, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``size`` bytes: first row, row behind the last, their bytes and offsets."""
    data, offsets = text_buffer(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        yield row, stop, data[offsets[row]:offsets[stop]], offsets[row:stop + 1] - offsets[row]
        row = stop


@dataclass
class Words:
    """Hashes of all words of some texts, their byte ranges, and where each text's words begin."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    lowered: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words_of(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = BLANKS, lower: bool = True,
             breaks: np.ndarray | None = None) -> Words:
    """The words of some texts; a word also begins at each place that ``breaks`` marks."""
    lowered = LOWER[data] if lower else data
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), none, none, np.zeros(len(offsets), np.int64), lowered)
    inside = ~separators[lowered]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    edges = offsets[(offsets > 0) & (offsets < n)]
    opens[edges] = inside[edges]
    if breaks is not None:
        opens |= breaks & inside
    starts = np.flatnonzero(opens)
    if not len(starts):
        return Words(np.zeros(0, np.uint64), starts, starts, np.zeros(len(offsets), np.int64), lowered)
    # a word ends where no word goes on: at a separator, at the next text or at the end
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | opens[1:]
    ends = np.flatnonzero(closes) + 1
    place = np.arange(n, dtype=np.int64)
    lead = int(starts[0])
    place[lead:] -= np.repeat(starts, np.diff(np.append(starts, n)))
    place[~inside] = 0
    table = powers(int((ends - starts).max()) + 1)
    parts = table[place] * (lowered.astype(np.uint64) + np.uint64(1))
    parts[~inside] = 0
    sums = np.add.reduceat(parts, starts)
    hashes = mix(sums + (ends - starts).astype(np.uint64) * CHAIN)
    return Words(hashes, starts, ends, np.searchsorted(starts, offsets), lowered)


def chained(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` hashes; one value per start."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    runs = hashes[:n].copy()
    for i in range(1, k):
        runs = mix(runs * CHAIN + hashes[i:i + n])
    return mix(runs + np.uint64(k))


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """All runs of ``k`` words of one text; a shorter text is one run; no word, no run."""
    n = len(hashes)
    return chained(hashes, k) if n >= k else chained(hashes, n) if n else hashes[:0]


def shingles_of(words: Words, k: int) -> Iterator[np.ndarray]:
    """``shingles`` of each text, hashed together."""
    runs = chained(words.hashes, k)
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        yield runs[a:b - k + 1] if b - a >= k else shingles(words.hashes[a:b], k)


def word_hash(word: str) -> np.uint64:
    data = np.frombuffer(word.encode(), np.uint8)
    return words_of(data, np.array([0, len(data)]), np.zeros(256, bool)).hashes[0]


def signed(values: np.ndarray) -> np.ndarray:
    """The same bits as Spark's ``long``."""
    return np.ascontiguousarray(values).view(np.int64)


def over_texts(column, each: Callable[[Words], Iterator], separators: np.ndarray = BLANKS) -> list:
    """One result of ``each`` per row, in order, whatever the slices."""
    found: list = []
    for _, _, data, offsets in slices(column):
        found.extend(each(words_of(data, offsets, separators)))
    return found
