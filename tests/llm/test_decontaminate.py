"""Benchmark decontamination against trying every window."""

import random
from collections import Counter

from feedback_loom.llm import decontaminate, queries


def by_hand(docs, items, k=5, percent=80):
    """Best window similarity of each document and item by comparing all windows."""
    def shingles(words):
        return [tuple(words[i:i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [tuple(words)] if words else []

    found = {}
    for doc, text in docs:
        words = (text or "").encode().lower().split()
        for item, wanted in items:
            other = (wanted or "").encode().lower().split()
            target = Counter(shingles(other))
            if not target:
                continue
            n = len(other)
            for at in range(max(1, len(words) - n + 1)):
                window = words[at:at + n]
                if len(window) < min(n, k) or (n < k and len(window) < n):
                    continue
                own = Counter(shingles(window))
                common = sum((own & target).values())
                larger = sum((own | target).values())
                if common and 100 * common >= percent * larger:
                    found[doc, item] = max(found.get((doc, item), 0), common / larger)
    return found


def test_windows_equal_brute_force(spark):
    rng = random.Random(2)
    word = lambda: f"w{rng.randrange(300)}"
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([3, 4, 5, 12, 18, 18, 30, 45, 45, 60])]
    items += [(90, ""), (91, None), (92, "ab ab ab ab ab ab ab ab")]
    docs = []
    for d in range(120):
        words = [word() for _ in range(rng.randrange(0, 90))]
        if d % 2:
            copy = rng.choice(items)[1] or ""
            copy = copy.split()
            for _ in range(rng.randrange(3)):
                if copy:
                    copy[rng.randrange(len(copy))] = word()
            at = rng.randrange(len(words) + 1)
            words[at:at] = copy[rng.randrange(2):]
        docs.append((d, " ".join(words)))
    docs += [(500, None), (501, " ".join(items[6][1].split()[1:]))]
    got = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                              spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in got.collect()} == {
        key: round(v, 9) for key, v in by_hand(docs, items).items()}


def test_blocks_of_items_give_the_same(spark, folder, monkeypatch):
    whole = {tuple(r) for r in queries.op7_benchmark_decontamination(spark, folder).collect()}
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 2000)
    assert whole and {tuple(r) for r in queries.op7_benchmark_decontamination(spark, folder).collect()} == whole


def test_looking_up_near_values_equals_looking_through():
    import numpy as np

    rng = np.random.default_rng(1)
    one = decontaminate.SizeClass(20, 5, 80)
    for i in range(400):
        one.add(i, rng.integers(0, 2 ** 63, 16).astype(np.uint64))
    one.close()
    for mark in decontaminate.fingerprints(rng.normal(size=(20, 64))):
        mark = np.where(rng.random(4) < 0.5, mark, one.prints[3])
        through = one.near(mark).tolist()
        masks, one.masks = one.masks, one.masks
        ids, one.ids = one.ids, one.ids[:]
        one.masks, size = masks, len(masks)
        one.ids = list(range(size + 1))
        assert sorted(one.near(mark).tolist()) == sorted(through)
        one.ids = ids


def test_edge_rows_and_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g", "x"), (1, "a b c d e f g", "y"), (None, "a b c d e f g", "z"), (2, "", "w")],
                                 "doc_id long, text string, item_id string")
    items = spark.createDataFrame([(7, "A b c d e f g"), (7, "A b c d e f g"), (None, "a b c d e")], "item_id long, text string")
    assert [tuple(r) for r in decontaminate.leaks(docs, items).collect()] == [(1, 7, 1.0, 0, 7)]
    assert decontaminate.leaks(docs, items.limit(0)).collect() == [] and decontaminate.leaks(docs.limit(0), items).collect() == []
    assert sorted(r.item_id for r in decontaminate.without_leaks(docs, items).collect()) == ["w", "z"]
