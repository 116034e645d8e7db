"""Toxicity: the kernel against its definition, and accuracy on held-out rows."""

from itertools import combinations

import numpy as np
import pyarrow as pa

from feedback_loom.llm import toxicity
from feedback_loom.llm.words import slices, words_of


def defined(a: bytes, b: bytes) -> float:
    """The squared, normalised subsequence kernel by enumeration."""
    def vector(word):
        found = {}
        for i, j, k in combinations(range(len(word)), 3):
            classes = [int(toxicity._CLASS[word[x]]) for x in (i, j, k)]
            if min(classes) >= 0:
                found[tuple(classes)] = found.get(tuple(classes), 0.0) + toxicity.DECAY ** (k - i + 1)
        return found

    x, y = vector(a), vector(b)
    size = (sum(v * v for v in x.values()) * sum(v * v for v in y.values())) ** 0.5
    return (sum(v * y.get(n, 0.0) for n, v in x.items()) / size) ** 2 if size else 0.0


def test_kernel_equals_its_definition():
    words = [b"idiot", b"i.d.i.o.t", b"idxiot", b"table", b"stupid", "fédérée".encode(), b"aaaa", b"ab", b"a1b2c3"]
    got = toxicity.Landmarks(words).of(words)
    expected = [[defined(a, b) for b in words] for a in words]
    assert np.allclose(got, expected, atol=1e-5)
    assert got[0, 1] > 0.8 and got[0, 2] > 0.4 and got[0, 3] < 0.1


def test_long_words_are_read_in_windows():
    word = b"x" * 3 + b"-" * 200 + b"idiot" + b"-" * 50
    assert toxicity.Landmarks([b"idiot"]).of([word, b"y" * 300])[:, 0].tolist()[0] > 0.5
    assert toxicity.Landmarks([b"idiot"]).of([b"idiot" * 40])[0, 0] > 0.2


TOXIC, CLEAN = ["idiot", "moron", "stupid", "loser"], "the a house river walks slowly over green fields with many birds".split()


def labelled(n, seed=0):
    rng = np.random.default_rng(seed)
    for i in range(n):
        words = [CLEAN[j] for j in rng.integers(0, len(CLEAN), 60)]
        if i % 3 == 0:
            words[int(rng.integers(0, 60))] = TOXIC[int(rng.integers(0, 4))]
        yield " ".join(w + ("." if j % 9 == 8 else "") for j, w in enumerate(words)), int(i % 3 == 0)


def scores(model, texts):
    return np.concatenate([model.score(words_of(d, o)) for _, _, d, o in slices(pa.array(texts, pa.string()))])


def test_gapped_insults_and_clean_texts():
    texts, labels = zip(*labelled(300))
    model = toxicity.fitted(list(texts), list(labels))
    new, truth = zip(*labelled(200, seed=1))
    assert ((scores(model, list(new)) >= 0.5) == np.array(truth)).mean() > 0.98
    got = scores(model, ["you i.d.i.o.t you", "what an i d i o t", "a st-up-id walk", "a house by the river", "", None, "IDIOT",
                         "green " * 500])
    assert (got[[0, 1, 2, 6]] >= 0.5).all() and (got[[3, 4, 5, 7]] < 0.5).all()


def test_whole_texts_are_read():
    texts, labels = zip(*labelled(300))
    model = toxicity.fitted(list(texts), list(labels))
    assert scores(model, ["the house walks. " * 20_000 + "idiot"])[0] >= 0.5


def test_one_label_or_none(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (None, "x")], "doc_id long, text string")
    none = spark.createDataFrame([(1, None), (7, 1)], "doc_id long, toxic int")
    clean = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")
    for labels in (none, clean):
        model = toxicity.trained(docs, labels)
        assert {r.score for r in toxicity.scored(docs, model).collect()} == {0.0}
    assert toxicity.scored(docs.limit(0), model).collect() == []


def test_rows_keep_their_columns_and_toxic_ones_go(spark):
    rows = [(i, t, y, "z") for i, (t, y) in enumerate(labelled(240))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int, _label string")
    kept = toxicity.without_toxic(docs.drop("label"), docs.select("doc_id", "label").withColumnRenamed("label", "toxic")).collect()
    assert {r.doc_id for r in kept} == {i for i, _, y, _ in rows if not y} and kept[0]._label == "z"
