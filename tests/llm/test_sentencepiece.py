"""SentencePiece ids equal the library's on whole texts, whatever the chunks; decoding gives the text again."""

import public_tokenizers as tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from feedback_loom.llm import queries, sentencepiece_codec as codec

PATH = tokenizers.path("piece_bpe_32k.model")
OWN = codec.codec(PATH)


def scanned(text, chunk):
    """Ids by cutting a text into chunks, as giant documents are."""
    marked, margin = (" " + text).replace(" ", codec.MARK), 2 * OWN.longest
    matrices, ends, lefts = [], [], range(0, len(marked), chunk)
    for left in lefts:
        right, low = min(len(marked), left + chunk), max(0, left - margin)
        part = marked[low:right + margin]
        matrices.append(codec.chunk_matrix(OWN, part, left - low, right - low))
        ends.append([e - left + low for _, e in OWN.covering(part, right - low)])
    ids, begin = [], 0
    for left, state, found in zip(lefts, codec.boundary_pieces(matrices), ends):
        stop = found[state]
        ids += OWN.stretch_ids(marked[left + begin:left + stop]).tolist() if stop > begin else []
        begin = stop - chunk
    return ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("etaoinshr  lcu\n=-*é☃𐍈1"), min_size=1, max_size=250), st.sampled_from([33, 40, 70, 90]))
def test_chunks_give_the_ids_of_the_whole(text, chunk):
    assert scanned(text, chunk) == OWN.model.encode(text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80).filter(lambda t: codec.MARK not in t))
def test_any_text_equals_the_library_and_comes_back(text):
    ids = OWN.encode(text).tolist()
    assert ids == OWN.model.encode(text) and OWN.decode(ids) == text


def test_products_are_associative():
    import numpy as np

    rng = np.random.default_rng(0)
    a, b, c = (np.where(rng.random(s) < 0.5, 0.0, -np.inf) for s in ((3, 4), (4, 5), (5, 2)))
    left, right = codec.product(codec.product(a, b), c), codec.product(a, codec.product(b, c))
    assert (left == right).all()


def test_states_between_two_states_follow_the_whole_path():
    import numpy as np

    rng = np.random.default_rng(1)
    sizes = [1, *rng.integers(2, 6, 11).tolist()]
    matrices = [-rng.random((m, n)) for m, n in zip(sizes, sizes[1:])]
    whole = codec.boundary_pieces(matrices)
    halves = [codec.combined(matrices[:5]), codec.combined(matrices[5:])]
    enter, leave = codec.boundary_pieces(halves)
    assert (enter, leave) == (whole[4], whole[-1])
    assert codec.boundary_pieces(matrices[:5], 0, enter) + codec.boundary_pieces(matrices[5:], enter, leave) == whole


@pytest.mark.parametrize("giant, chunk, fan", [(1 << 15, 1 << 14, 64), (300, 64, 5)])
def test_tables_with_giant_documents(spark, giant, chunk, fan):
    texts = ["", None, " ", "a  b\n", "word " * 30_000, "=" * 40_000, "nospaceshere" * 4_000, "é☃ " * 12_000 + "\n\n", "plain text", "plain text"]
    docs = spark.createDataFrame([(i if i % 4 else None, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, chunk string")
    got = codec.decoded(codec.encoded(docs, PATH, giant=giant, chunk=chunk, fan=fan), PATH).collect()
    assert sorted((str(r.doc_id), str(r.text), str(r.ids)) for r in got) == sorted(
        (str(i if i % 4 else None), str(t), str(None if t is None else OWN.model.encode(t))) for i, t in enumerate(texts))
    assert all(r.decoded == r.text for r in got)
    assert codec.encoded(docs.limit(0), PATH).collect() == []


def test_whole_table_comes_back(spark, folder):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.op10_sentencepiece(spark, folder).collect()
    assert len(rows) == len(texts) and all(r.round_trip and r.ids == OWN.model.encode(texts[r.doc_id]) for r in rows)


def test_clashing_names_give_way(spark):
    docs = spark.createDataFrame([(1, "a b", "x", 5), (2, "w " * 40_000, "y", 6)], "doc_id long, text string, IDS string, _uid int")
    got = {r.doc_id: r for r in codec.encoded(docs, PATH).collect()}
    assert all(r.ids == OWN.model.encode(r.text) and len(r) == 3 for r in got.values()) and len(got) == 2
