"""Token counts of fields or sections by offset-mapped attribution.

A whole document is encoded once. The tokens of a byte-level vocabulary cover its bytes, so
their lengths give byte spans, and the document's lead bytes turn those into character
spans. Token spans and section spans are both sorted and are joined by their boundaries. A token
that touches more than one section goes to the one it shares most characters with, the
earlier one on ties (``rule="largest"``), or to the one of its first character (``rule="first"``). So
every token is counted once, and counts add up to those of whole documents. A character
split over several tokens belongs to each of them.
"""

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .columns import few_rows

RULES = ("largest", "first")


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str):
    """The vocabulary of a rank file and the length in bytes of each token."""
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}
    lengths = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    return tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths


def token_spans(text: str, path: str, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """First character and end of each token's span."""
    coder, lengths = encoding(path, pattern)
    tokens = coder.encode_to_numpy(text, disallowed_special=())
    ends = np.cumsum(lengths[tokens])
    starts = ends - lengths[tokens]
    data = np.frombuffer(text.encode(), np.uint8)
    if len(data) == len(text):
        return starts, ends
    number = np.cumsum((data & 0xC0) != 0x80) - 1
    return number[starts], number[ends - 1] + 1


def attributed(starts: np.ndarray, ends: np.ndarray, low: np.ndarray, high: np.ndarray, rule: str = "largest") -> np.ndarray:
    """Tokens per section for sorted sections ``[low, high)`` without overlap; tokens outside all count nowhere."""
    counts = np.zeros(len(low), np.int64)
    if not len(low) or not len(starts):
        return counts
    one = np.searchsorted(high, starts, "right")  # the first section that ends behind the token's start
    two = np.searchsorted(low, ends, "left") - 1  # the last that begins before its end
    if rule == "first":
        inside = (one < len(low)) & (low[np.minimum(one, len(low) - 1)] <= starts)
        return np.bincount(one[inside], minlength=len(low))
    single = one == two
    counts += np.bincount(one[single], minlength=len(low))
    for t in np.flatnonzero(one < two).tolist():
        shared = np.minimum(high[one[t]:two[t] + 1], ends[t]) - np.maximum(low[one[t]:two[t] + 1], starts[t])
        if shared.max() > 0:
            counts[one[t] + int(shared.argmax())] += 1
    return counts


def lines(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sections of a text at line feeds, each with its line feed; an empty text is one section."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    cuts = np.flatnonzero(points == 10) + 1
    low = np.concatenate([[0], cuts[cuts < len(points)]])
    return low, np.append(low[1:], len(points))


def fields_as_sections(df: DataFrame, fields: list[str], text: str = "text", sections: str = "sections",
                       separator: str = "\n") -> DataFrame:
    """Join text columns to one ``text`` and give each as a section ``(start, end)`` of characters; null counts as empty."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fields]
    found, at = [], F.lit(0)
    for i, part in enumerate(parts):
        end = at + F.char_length(part)
        found.append(F.struct(at.alias("start"), end.alias("end")))
        at = end + (len(separator) if i + 1 < len(parts) else 0)
    return df.withColumns({text: F.concat_ws(separator, *parts), sections: F.array(*found)})


def section_tokens(docs: DataFrame, path: str, pattern: str, text: str = "text", key: str = "doc_id",
                   sections: str | Column | None = None, rule: str = "largest") -> DataFrame:
    """``(key, section, start, end, n_tokens)``: tokens of each section of each row, in characters.

    ``sections`` is an array of ``(start, end)``, sorted and without overlap; null sections or
    none given mean the lines of the text. ``path`` and ``pattern`` are those of a byte-level
    vocabulary, readable on every executor. A null text counts as empty; an empty text has one
    empty section. Keys may repeat or be null; other columns are ignored.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    given = sections if isinstance(sections, Column) else F.col(sections) if sections else F.lit(None)
    kind = "array<struct<start: long, end: long>>"
    out = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64())]

    def each(texts, spans) -> Iterator[tuple]:
        for value, own in zip(texts, spans):
            value = value.as_py() or ""
            if own.is_valid:
                low = np.array([s["start"] for s in own.as_py()], np.int64)
                high = np.array([s["end"] for s in own.as_py()], np.int64)
                if (low > high).any() or (high[:-1] > low[1:]).any():
                    raise ValueError("sections must be sorted and must not overlap")
            else:
                low, high = lines(value)
            starts, ends = token_spans(value, path, pattern)
            yield low, high, attributed(starts, ends, low, high, rule)

    def run(batches):
        for batch in few_rows(batches):
            columns = list(zip(*each(batch.column(1), batch.column(2)))) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), *(pa.array(c, t) for c, t in zip(columns, out[1:]))],
                names=["key", "low", "high", "n"])

    found = (docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"),
                         given.cast(kind).alias("sections"))
             .mapInArrow(run, "key long, low array<long>, high array<long>, n array<long>"))
    rows = found.select("key", F.posexplode(F.arrays_zip("low", "high", "n")).alias("section", "one"))
    return rows.select(F.col("key").alias(key), "section", F.col("one.low").alias("start"), F.col("one.high").alias("end"),
                       F.col("one.n").alias("n_tokens"))
