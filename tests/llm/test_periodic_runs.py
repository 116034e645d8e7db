"""Periodic runs against a search of all lags, and the query against its rule in plain Python."""

import hashlib
import random
import re
import zlib

from hypothesis import given, settings, strategies as st

import numpy as np
from pyspark.sql import functions as F

from feedback_loom.llm import periodic_runs, queries


def plain_runs(words):
    n, runs = len(words), set()
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length >= max(24, 3 * q) and not any(r[0] <= start and start + length <= r[0] + r[1] for r in runs):
                runs.add((start, length, q))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def plain(doc_id, text, planted=True):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if planted and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()), runs, kept.decode()


def test_whole_table_equals_plain_search(spark, folder):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = queries.op11_periodic_runs(spark, folder).collect()
    assert len(got) == len(docs) and sum(r.n_runs for r in got) > 0
    for r in got:
        assert tuple(r)[1:] == plain(r.doc_id, docs[r.doc_id])[0], r.doc_id


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=40), st.integers(1, 9)), max_size=6))
def test_sequences_of_powers_equal_all_lags(parts):
    words = [w for block, times in parts for w in block * times]
    marks = np.array([w + 1 for w in words], np.uint64)
    assert [tuple(r) for r in periodic_runs.periodic_runs(marks).tolist()] == plain_runs(words)


def test_long_periods_hold_their_seed_several_times():
    rng = random.Random(3)
    for size in (17, 31, 32, 33, 64, 100, 257):
        for _ in range(5):
            half = [rng.randrange(3) for _ in range(size)]
            block = half + half + [9]  # every k-gram of the first half comes twice in a period
            words = block * 3 + half[: rng.randrange(size)] + [7] * rng.randrange(40)
            marks = np.array([w + 1 for w in words], np.uint64)
            assert [tuple(r) for r in periodic_runs.periodic_runs(marks).tolist()] == plain_runs(words)


def test_edges(spark):
    texts = [None, "", " \t\n", "one", "a " * 23, "a " * 24, "A a " * 24, "a b " * 30, "a b c d e f g h " * 3, "a b c d e f g h i " * 3,
             "x" * 100_000 + " y" * 30, "w " * 200_000, " ".join(map(str, range(30_000))) + " " + " ".join(map(str, range(30_000))),
             " ".join(str(i % 10_000) for i in range(30_001)), "é ü " * 20, "a " * 20, "a " * 20]
    docs = spark.createDataFrame([(i // 2, t, "mine") for i, t in enumerate(texts)], "doc_id long, text string, RUNS string")
    got = periodic_runs.with_runs(docs.coalesce(1)).collect()
    for r, text in zip(got, texts):
        if len(text or "") < 10_000:
            _, runs, kept = plain(r.doc_id, text, planted=False)
            assert [tuple(x) for x in r.runs] == runs and r.collapsed == kept
    assert [tuple(x) for x in got[10].runs] == [(1, 30, 1)]
    assert [tuple(x) for x in got[11].runs] == [(0, 200_000, 1)] and got[11].collapsed == "w"
    assert got[12].runs == [] and got[12].n_words == 60_000
    assert [tuple(x) for x in got[13].runs] == [(0, 30_001, 10_000)] and len(got[13].collapsed.split()) == 10_000
    assert periodic_runs.with_runs(docs.limit(0)).collect() == []


def test_runs_do_not_cross_texts_and_ties_go_to_the_first(spark):
    docs = spark.createDataFrame([(1, "a " * 20), (1, "a " * 20), (2, "b " * 24 + "c " * 24), (None, "d " * 24)], "doc_id long, text string")
    got = periodic_runs.with_runs(docs.coalesce(1)).withColumn("best", periodic_runs.strongest(F.col("runs"))).collect()
    assert [r.n_words for r in got] == [20, 20, 48, 24] and [len(r.runs) for r in got] == [0, 0, 2, 1]
    assert tuple(got[2].best) == (0, 24, 1) and got[0].best is None and got[2].collapsed == "b c"
    kept = periodic_runs.with_planted_repeats(docs).collect()
    assert kept[3].text == "d " * 24
