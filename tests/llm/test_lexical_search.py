"""Ranked search against scores of all documents in plain Python, and what the tree leaves out."""

import math
import random
import re
from collections import Counter

import numpy as np
from compare import difference, duck

from feedback_loom.llm import lexical_search, queries


def terms_of(text):
    return [t.lower() for t in re.findall(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").encode())]


def plain(docs, items, k=20):
    """docs: (id, text) rows; items: (id, text) rows."""
    counts = [(i, Counter(terms_of(t))) for i, t in docs if terms_of(t)]
    total, words = len(counts), sum(sum(c.values()) for _, c in counts)
    holders = Counter(t for _, c in counts for t in c)
    found = []
    for item, text in {(i, t) for i, t in items if t is not None}:
        scores = []
        for doc, c in counts:
            m = 75 + 25 * sum(c.values()) * total // words
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * holders[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                        for t in terms_of(text) if c[t])
            if score > 0 and doc is not None:
                scores.append((-score, doc))
        found.extend((item, rank, doc, -score) for rank, (score, doc) in enumerate(sorted(scores)[:k], 1))
    return sorted(found, key=repr)


def test_whole_table_equals_sql(spark, folder):
    got = queries.op12_ranked_search(spark, folder).toPandas()
    assert difference(got, duck(folder).execute(queries.ORACLES["op12_ranked_search"]).df()) is None


def test_random_tables_equal_all_scores(spark, monkeypatch):
    rng = random.Random(5)
    words = ["w%d" % i for i in range(60)]

    def text():
        return " ".join(rng.choices(words, weights=[1 / (i + 1) for i in range(60)], k=rng.randrange(1, 40)))

    docs = [(i, text()) for i in range(300)]
    docs += [(i, docs[i][1].upper()) for i in range(40)] + [(1000 + i, docs[7][1]) for i in range(30)]
    docs += [(None, docs[7][1]), (2000, None), (2001, ""), (2002, "-- !"), (2003, "é1 É1 ß"), (2004, "w1 " * 50_000)]
    items = [(i, text()) for i in range(40)] + [(3, docs[7][1]), (3, docs[7][1]), (4, "w1 w1 w1"), (50, None), (51, ""), (52, "none"),
                                               (None, "w2 w59"), (53, "É1 é1")]
    frame = spark.createDataFrame([(i, t, 1, 1) for i, t in docs], "doc_id long, text string, score int, ITEM int").repartition(5)
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    for bytes_, group, cells in ((2 << 20, 4096, 1 << 21), (500, 16, 64)):
        monkeypatch.setattr(lexical_search, "BLOCK_BYTES", bytes_)
        monkeypatch.setattr(lexical_search, "GROUP_TERMS", group)
        monkeypatch.setattr(lexical_search, "CELLS", cells)
        got = lexical_search.ranked(frame, asked, k=7).collect()
        assert sorted(map(tuple, got), key=repr) == plain(docs, items, 7)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = docs.withColumnRenamed("doc_id", "item_id")
    assert lexical_search.ranked(docs.limit(0), items).collect() == []
    assert lexical_search.ranked(docs, items.limit(0)).collect() == []
    assert [tuple(r) for r in lexical_search.ranked(docs, items).collect()] == plain([(1, "a b")], [(1, "a b")])


def test_weak_batches_are_pruned_as_a_whole():
    rng = np.random.default_rng(1)
    items = [(np.arange(10 * i, 10 * i + 10), np.ones(10, np.int64)) for i in range(20)]
    weights = np.full(200, 100)
    best = lexical_search.Best(5, np.ones(20, np.int64))
    table = np.zeros((64, 200), np.int64)
    for i in range(20):
        table[rng.choice(64, 8, replace=False)[:, None], items[i][0]] = 1000
    docs = np.arange(64)
    (root,) = lexical_search.item_tree(items, weights)
    assert sorted(root.items) == list(range(20)) and len(root.terms) == 200
    first = lexical_search.search(root, lexical_search.doc_levels(table), docs, best)
    weak = lexical_search.search(root, lexical_search.doc_levels(table // 2), docs + 64, best)
    assert 0 < first <= 64 * 20 and weak == 0
    for i in range(20):
        exact = sorted((-s, d) for d, s in zip(docs, table[:, items[i][0]].sum(axis=1)) if s)[:5]
        assert sorted(zip(-best.found[i][0], best.found[i][1])) == exact


def test_bounds_hold_for_all_below():
    rng = np.random.default_rng(2)
    items = [(np.sort(rng.choice(50, 6, replace=False)), rng.integers(1, 4, 6)) for _ in range(30)]
    roots = lexical_search.item_tree(items, rng.integers(1, 100, 50))
    table = rng.integers(0, 100, (40, 50))
    levels = lexical_search.doc_levels(table)

    def check(node):
        top = levels[-1][0, node.terms] @ node.numbers
        for i in node.items:
            assert top >= (table[:, items[i][0]] @ items[i][1]).max()
        for child in node.below:
            assert set(child.items) <= set(node.items)
            check(child)

    for root in roots:
        check(root)
    assert sorted(i for r in roots for i in r.items) == list(range(30))
