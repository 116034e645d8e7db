"""Packing against whole-text encodings, the capacity, and lower bounds on the number of sequences."""

import random
import struct
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from feedback_loom.llm import packing, queries, vocabularies

PATH = vocabularies.path("word_bpe_49k.json")
HARD = [None, "", " ", "a", "The THE the, the. The's don't DON'T 'twas o'clock", "<|endoftext|> x<|startoftext|>y <|ENDOFTEXT|> <| the The",
        "éÉ é É, ́ ́a …. —. a—.b x.'s y!'ll z.,;:!?", "日本語、テスト。 　全角 nbsp line\u0085next", "\x00\x1c\x1d a\x0bb\x0cc",
        "ΑΣ ΌΣΟΣ Σ. İstanbul ǅ ﬁ ß ẞ", "12 345 6.7,8", "😀😀 👩‍👩‍👧 🇩🇪", "x" * 5000, "a.b.c,d;e:f!g?h " * 300, "'s 's's ''s a's.'s"]


def whole(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_ids_equal_whole_texts():
    rng = random.Random(1)
    texts = HARD + ["".join(rng.choices("ab .,;:'!?<|>éΣ\n-_1", k=60)) for _ in range(2000)]
    got = list(packing.WordEncoder(PATH).encode(pa.array(texts, pa.string())))
    assert [g.tolist() for g in got] == whole(texts)


def test_forgetting_changes_nothing(monkeypatch):
    texts = ["word%d the %d" % (i % 50, i) for i in range(300)]
    monkeypatch.setattr(packing, "REMEMBERED", 40)
    encoder = packing.WordEncoder(PATH)
    got = [g.tolist() for low in range(0, 300, 7) for g in encoder.encode(pa.array(texts[low:low + 7]))]
    assert got == whole(texts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 30), st.integers(1, 4), st.floats(0.01, 2)), min_size=1, max_size=6, unique_by=lambda x: x[0]),
       st.integers(30, 40))
def test_knapsack_equals_enumeration(items, capacity):
    lengths, copies, prices = (np.array(x) for x in zip(*items))

    def best(i, left):
        if i == len(items):
            return 0.0
        return max(prices[i] * n + best(i + 1, left - n * lengths[i]) for n in range(copies[i] + 1) if n * lengths[i] <= left)

    found = packing.knapsack(lengths, copies, prices, capacity)
    of = dict(zip(lengths.tolist(), range(len(items))))
    assert sum(n * t for n, t in found.items()) <= capacity and all(t <= copies[of[n]] for n, t in found.items())
    assert sum(prices[of[n]] * t for n, t in found.items()) == pytest.approx(best(0, capacity))


def filled(counts, capacity):
    """All places of a plan, checked for gaps and overlaps."""
    plan = packing.plan(counts, capacity)
    lengths = np.repeat(list(counts), list(counts.values())).astype(np.int64)
    ranks = np.concatenate([np.arange(n) for n in counts.values()]) if counts else np.zeros(0, np.int64)
    sequence, offset = plan.places(lengths, ranks) if len(ranks) else (ranks, ranks)
    order = np.lexsort((offset, sequence))
    lengths, sequence, offset = lengths[order], sequence[order], offset[order]
    first = np.append(True, sequence[1:] != sequence[:-1])[:len(lengths)]
    assert (offset[first] == 0).all()
    assert (offset[1:][~first[1:]] == (offset + lengths)[:-1][~first[1:]]).all()
    assert len(lengths) == 0 or (offset + lengths).max() <= capacity
    assert set(sequence.tolist()) == set(range(plan.sequences))
    return plan.sequences


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=30))
def test_plans_are_whole(counts):
    assert filled(counts, 64) >= -(-sum(n * c for n, c in counts.items()) // 64)


def test_plans_are_near_the_lower_bound():
    rng = np.random.default_rng(1)
    assert filled({2049: 10, 1365: 7, 1: 5}, 4096) == 10
    assert filled({1365: 3000}, 4096) == 1000 and filled({2048: 11, 4096: 5}, 4096) == 11
    spread = Counter(np.clip(rng.lognormal(6.3, 0.9, 20_000).astype(int), 1, 4095).tolist())
    assert filled(spread, 4096) <= 1.001 * -(-sum(n * c for n, c in spread.items()) // 4096) + 1
    triplets = []
    for _ in range(300):
        a = int(rng.integers(1030, 1500))
        b = int(rng.integers(1030, 4096 - a - 1025))
        triplets += [a, b, 4096 - a - b]
    counts = dict(Counter(triplets))
    best_fit = sum(g.count for g in packing.rounded([], counts, 4096))
    assert 300 <= filled(counts, 4096) < best_fit


def test_plan_does_not_grow_with_rows():
    counts = {n: 10**9 + 7 * n for n in range(1, 4097)}
    plan = packing.plan(counts)
    assert len(plan.keys) < 30_000 and plan.sequences >= sum(n * c for n, c in counts.items()) // 4096


def test_whole_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    wanted, total = {}, 0
    for d, ids in zip(docs, whole([d.text for d in docs])):
        ids = [*ids, 1]
        total += len(ids)
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start:start + 4096]
            wanted[d.doc_id, piece] = (start, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part)))
    got = queries.op13_best_fit_packing(spark, folder).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == wanted and len(got) == len(wanted)
    ends = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 4096 and len(ends) <= 1.01 * total / 4096 + 1


def test_edges(spark):
    rows = [(1, t, 0, "q") for t in HARD] + [(7, "same text", 0, "q")] * 3000 + [(None, "null key", 0, "q"), (8, "a " * 9000, 0, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int, ROW string").repartition(3)
    got = packing.packed(docs, PATH, keep_ids=True).collect()
    assert len(got) == len(rows) + 2 + sum(len(i) >= 4096 for i in whole(HARD))
    assert sorted(r.length for r in got if r.doc_id == 8) == [809, 4096, 4096]
    assert sum(r.doc_id is None for r in got) == 1 and all(len(r.ids) == r.length for r in got)
    ends = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.length}I", *r.ids))
    assert packing.packed(docs.limit(0), PATH).collect() == []
