"""Near-duplicates against brute force, and its parts."""

import random

import numpy as np
import pytest
from pyspark.sql import Row

from feedback_loom.llm import columns, minhash, queries
from feedback_loom.operators.components import components


def brute_force(rows, k, percent):
    """Smallest reachable key by comparing all pairs."""
    sets = {}
    for key, text in rows:
        words = (text or "").encode().lower().split()
        sets[key] = frozenset(tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()
    parent = {key: key for key in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {key: (len(sets[key]), root(key)) for key in keys}


def family(seed, n, edits):
    """Copies of one text with a few words changed, so that pairs lie on both sides of the threshold."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10_000)}"
        yield " ".join(words)


@pytest.mark.parametrize("k", [4, 5])
def test_components_equal_brute_force(spark, k):
    texts = [*family(1, 40, 8), *family(2, 30, 5), "a b c", "A  b\tc", "a b c d", "", None, "   ", "one", "two"]
    random.Random(3).shuffle(texts)
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([Row(doc_id=i, text=t, component="x", bucket=1) for i, t in rows])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs, k=k).collect()}
    assert got == brute_force(rows, k, 80)


def test_blocks_of_a_bucket_find_links_between_components(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 400)
    monkeypatch.setattr(columns, "DEALT", 4)
    rows = list(enumerate([*family(5, 30, 9), *family(6, 12, 9)]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs, k=4).collect()}
    assert got == brute_force(rows, 4, 80)


def test_rows_grow_with_the_members_of_a_loose_group(spark, monkeypatch):
    """Copies of one text that are just too unlike: many share buckets, none a link; candidates must not be pairs of all."""
    rng, counted = random.Random(4), {}
    base = [f"w{rng.randrange(5000)}" for _ in range(300)]
    plain = minhash.verified

    def counting(pairs, sets, percent):
        counted[n] = counted.get(n, 0) + pairs.count()
        return plain(pairs, sets, percent)

    monkeypatch.setattr(minhash, "verified", counting)
    for n in (150, 300):
        rows = []
        for i in range(n):
            words = list(base)
            for place in rng.sample(range(300), 9):
                words[place] = f"x{rng.randrange(10 ** 9)}"
            rows.append((i, " ".join(words)))
        got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert {r.doc_id: r.component_id for r in got} == {i: c for i, (_, c) in brute_force(rows, 5, 80).items()}
        assert counted[n] <= 2 * n


def test_whole_table_equals_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op6_minhash_near_dedup(spark, folder).collect()}
    assert got == brute_force([(r.doc_id, r.text) for r in docs.collect()], 4, 80)


def test_null_keys_repeated_keys_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (3, None)],
                                 "doc_id long, text string")
    got = sorted(map(tuple, minhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(None, 2, None, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True)], key=str)
    kept = [r.doc_id for r in minhash.without_near_duplicates(docs).collect()]
    assert sorted(kept, key=str) == [1, 3, None]
    assert minhash.near_duplicates(docs.limit(0)).collect() == []


def test_signature_estimates_similarity_with_low_variance():
    rng = np.random.default_rng(0)
    errors = []
    for _ in range(60):
        pool = rng.integers(0, 2 ** 63, 150).astype(np.uint64)
        a, b = np.unique(pool[:120]), np.unique(pool[30:])
        errors.append((minhash.signature(a) == minhash.signature(b)).mean() - 90 / 150)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < (0.6 * 0.4 / minhash.SLOTS) ** 0.5 * 1.2


def test_early_stopping_changes_nothing():
    elements = np.random.default_rng(1).integers(0, 2 ** 63, 40).astype(np.uint64)
    best = minhash.signature(elements)
    assert np.isfinite(best).all() and best.max() < minhash.SLOTS
    # a superset can only lower slots
    more = np.concatenate([elements, elements + np.uint64(5)])
    assert (minhash.signature(more) <= best).all()


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (None, 3), (200, 150)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}, 200: 150, 150: 150}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
