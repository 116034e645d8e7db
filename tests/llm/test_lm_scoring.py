"""Language-model scores against exact counts."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from feedback_loom.llm import lm_scoring, queries
from feedback_loom.session import CLEANUP, to_table, without_old_shuffles


def tokens(text):
    return (text or "").encode().lower().split() + [None]


def exact(train, texts):
    """Base scores and model scores by dictionaries; counts are floored to their level, as the filter keeps them."""
    words = Counter(w for t in train for w in tokens(t))
    pairs = Counter(p for t in train for p in zip(["^", *tokens(t)[:-1]], tokens(t)))
    n, v, ends = sum(words.values()), len(words), words[None]
    seen, different = Counter(), Counter()
    kind = lambda left: int(math.log2(ends if left == "^" else words[left]))
    for (left, _), c in pairs.items():
        seen[kind(left)] += c
        different[kind(left)] += 1
    floor = lambda c: c if c <= 2 else 2 ** (math.ceil(math.log2(c)) - 1) + 1
    for text in texts:
        base = score = 0.0
        for left, right in zip(["^", *tokens(text)[:-1]], tokens(text)):
            own = (words[right] + 1) / (n + v + 1)
            base += math.log10(own)
            of_left = ends if left == "^" else words[left]
            if of_left:
                weight = seen[kind(left)] / (seen[kind(left)] + different[kind(left)])
                own = weight * floor(pairs[left, right]) / of_left + (1 - weight) * own
            score += math.log10(own)
        yield len(tokens(text)), sum(words[t] > 0 for t in tokens(text)), base, score


def test_whole_table_equals_exact_counts(spark, folder):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs}
    expected = dict(zip(docs, exact([t for i, t in docs.items() if not held[i]], docs.values())))
    errors = []
    for r in queries.op3_lm_scoring(spark, folder).collect():
        n, known, base, score = expected[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known) == (held[r.doc_id], n, known)
        assert r.base_score == pytest.approx(base, abs=1e-6)
        errors.append((r.score - score) / n)
    # false positives of the filter can only raise a probability
    assert min(errors) > -1e-9 and np.mean(errors) < 0.02


def test_shards_and_edge_rows(spark):
    train = spark.createDataFrame([("a b c a b",), ("a b d",), (None,), ("",)], "text string")
    docs = spark.createDataFrame([(1, "A b", "x"), (1, "A b", "x"), (None, None, "y"), (2, "", "z"), (3, "zz zz", "u")],
                                 "doc_id long, text string, _row string")
    one = lm_scoring.trained(train)
    many = lm_scoring.trained(train, max_bytes=50)
    assert one.shards == 1 and many.shards > 1
    found = [sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 9), round(r.score, 1))
                    for r in lm_scoring.scored(docs, m).collect()) for m in (one, many)]
    assert found[0] == found[1] and len(found[0]) == 5
    expected = dict(zip("1 2 3".split(), exact(["a b c a b", "a b d", None, ""], ["A b", "", "zz zz"])))
    for key, n, known, base, _ in found[0]:
        if key in expected:
            assert (n, known) == expected[key][:2] and base == pytest.approx(expected[key][2], abs=1e-6)
    empty = lm_scoring.trained(train.limit(0))
    assert [r.n_known for r in lm_scoring.scored(docs.where("doc_id = 3"), empty).collect()] == [0]
    assert lm_scoring.scored(docs.limit(0), one).collect() == []


def test_filters_are_in_the_bound_too(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 60, 200)) for _ in range(60)]
    train = spark.createDataFrame([(t,) for t in texts], "text string")
    docs = spark.createDataFrame(list(enumerate(texts[:5])), "doc_id long, text string")
    one, many = lm_scoring.trained(train), lm_scoring.trained(train, max_bytes=4000)
    assert one.shards == 1 and many.shards > 1
    for i in range(many.shards):
        for j in range(many.shards):
            words = lm_scoring._broadcast_words(spark, many.words, i, j, many.shards)
            cell = lm_scoring._broadcast_filter(spark, many.blocks, i, j, many.buckets)
            parts = [words.value.hashes[1:], words.value.counts[1:], words.value.start, cell.value.bits, cell.value.start, cell.value.size]
            assert sum(x.nbytes for x in parts) <= 4000
            words.destroy()
            cell.destroy()
    found = [{r.doc_id: (r.n_tokens, r.n_known, r.base_score, r.score) for r in lm_scoring.scored(docs, m).collect()} for m in (one, many)]
    for key, (n, known, base, score) in found[0].items():
        assert found[1][key][:2] == (n, known) and found[1][key][2] == pytest.approx(base) and abs(found[1][key][3] - score) < 0.02 * n


def test_levels_and_filter():
    assert lm_scoring.levels(np.array([1, 2, 3, 4, 5, 8, 9])).tolist() == [1, 2, 3, 3, 4, 4, 5]
    assert lm_scoring.floors(np.arange(6)).tolist() == [0, 1, 2, 3, 5, 9]
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 2 ** 58, 4000).astype(np.uint64))
    counts = rng.integers(1, 40, len(keys))
    block = lm_scoring.filter_block(keys, counts)
    held = lm_scoring.Filter(len(block), [{"bucket": 0, "block": block}], 1)
    read = held.level(keys)
    assert (read >= lm_scoring.levels(counts)).all() and (read == lm_scoring.levels(counts)).mean() > 0.97
    assert (held.level(rng.integers(0, 2 ** 58, 4000).astype(np.uint64)) > 0).mean() < 0.03


def test_a_model_of_any_size_takes_the_same_passes_and_gives_the_same_scores(spark, monkeypatch):
    rng = np.random.default_rng(5)
    # every third word is one hot word
    texts = [" ".join("hot" if i % 3 == 0 else f"w{i}" for i in rng.integers(0, 300, 150)) for _ in range(80)]
    train = spark.createDataFrame([(t,) for t in texts[:60]], "text string").repartition(3)
    docs = spark.createDataFrame([*enumerate(texts), (None, None), (7, "new words w1")], "doc_id long, text string")
    monkeypatch.setattr(lm_scoring, "CHUNK_BYTES", 2000)
    written = []
    to_table = lm_scoring.to_table
    monkeypatch.setattr(lm_scoring, "to_table", lambda df, name: written.append(name) or to_table(df, name))
    models, found, tables = [], [], []
    # the whole model fits, the words alone do, nothing fits
    for max_bytes in (1 << 20, 12_000, 6000, 2000):
        written.clear()
        models.append(lm_scoring.trained(train, max_bytes=max_bytes))
        rows = lm_scoring.scored(docs, models[-1], extra={"chunk": docs["doc_id"] % 2}).collect()
        found.append(sorted((str(r.doc_id), r.chunk, r.n_tokens, r.n_known, round(r.base_score, 9), round(r.score, 9)) for r in rows))
        tables.append(len(written))
    assert [m.shards > 1 for m in models] == [False, True, True, True] and models[1].shards < models[3].shards
    assert [bool(m.deal.parts) for m in models] == [False, False, False, True] and max(models[3].deal.parts) > 1
    assert tables[1] == tables[2] == tables[3] == tables[0] + 1
    assert found[0] == found[1] == found[2] and len(found[0]) == 82
    assert all(m.weights == models[0].weights for m in models)
    assert [r[:5] for r in found[0]] == [r[:5] for r in found[3]]
    # other blocks, so other errors of the filter, which can only raise a probability
    expected = {str(i): e for i, e in enumerate(exact(texts[:60], texts))} | {"None": next(exact(texts[:60], [None]))}
    for rows in (found[0], found[3]):
        errors = [(r[5] - expected[r[0]][3]) / r[2] for r in rows if r[0] != "7"]
        assert min(errors) > -1e-9 and np.mean(errors) < 0.02


def test_nothing_known_and_nothing_asked(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    nothing = lm_scoring.trained(docs.limit(0), max_bytes=50)
    assert nothing.shards > 1
    assert sorted((r.n_tokens, r.n_known, r.score) for r in lm_scoring.scored(docs, nothing).collect()) == [(1, 0, 0.0), (3, 0, 0.0)]
    assert lm_scoring.scored(docs.limit(0), lm_scoring.trained(docs, max_bytes=50)).collect() == []


def test_shuffle_files_go_when_their_query_ends(spark):
    store = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {b.toString() for b in spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(store.getAllBlocks())
                        if b.isShuffle() or "shuffle" in b.toString()}
    rows = spark.range(1000).repartition(5, "id")
    before = shuffles()
    kept = to_table(rows, "kept")
    assert shuffles() - before
    before = shuffles()
    with without_old_shuffles(spark):
        gone = to_table(rows, "gone")
    assert not shuffles() - before and kept.count() == gone.count() == 1000
    assert spark.conf.get(CLEANUP, None) in (None, "false")
