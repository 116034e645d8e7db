"""Token attribution against counting each token by hand."""

import public_tokenizers as tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from feedback_loom.llm import queries, token_counts

PATH, PATTERN = tokenizers.path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN


def by_hand(text, sections, rule):
    coder, _ = token_counts.encoding(PATH, PATTERN)
    counts, at, data = [0] * len(sections), 0, text.encode()
    for token in coder.encode_ordinary(text):
        end = at + len(coder.decode_single_token_bytes(token))
        starts = [i for i in range(at, end) if (data[i] & 0xC0) != 0x80]
        first = len(data[:at].decode("utf-8", "ignore")) if (data[at] & 0xC0) == 0x80 else len(data[:at].decode())
        chars = set(range(first, first + max(1, len(starts) + ((data[at] & 0xC0) == 0x80))))
        shared = [len(chars & set(range(a, b))) for a, b in sections]
        if rule == "first":
            shared = [int(min(chars) in range(a, b)) for a, b in sections]
        if shared and max(shared):
            counts[shared.index(max(shared))] += 1
        at = end
    return counts


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab \n.é☃𐍈xyz", max_size=60), st.lists(st.integers(0, 60), max_size=6), st.sampled_from(token_counts.RULES))
def test_every_token_goes_to_one_section(text, cuts, rule):
    import numpy as np

    edges = sorted({min(c, len(text)) for c in [0, *cuts, len(text)]})
    sections = list(zip(edges[:-1], edges[1:]))
    starts, ends = token_counts.token_spans(text, PATH, PATTERN)
    got = token_counts.attributed(starts, ends, np.array([a for a, _ in sections], int), np.array([b for _, b in sections], int), rule)
    assert got.tolist() == by_hand(text, sections, rule)
    assert got.sum() == (len(starts) if text else 0)


def test_whole_table_adds_up(spark, folder):
    found = queries.op4_token_counts(spark, folder)
    sums = {r.doc_id: (r.n, r.chars) for r in found.groupBy("doc_id").agg(
        F.sum("n_tokens").alias("n"), F.max("end").alias("chars")).collect()}
    coder, _ = token_counts.encoding(PATH, PATTERN)
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert sums == {r.doc_id: (len(coder.encode_ordinary(r.text)), len(r.text)) for r in docs}
    assert found.groupBy("doc_id").agg(F.max("section").alias("m"), F.count("*").alias("n")).where("m + 1 <> n").isEmpty()


def test_fields_of_a_row_are_sections(spark):
    rows = spark.createDataFrame([(1, "user", "hello there"), (2, None, ""), (None, "é", "ab\nc")], "k long, role string, said string")
    given = token_counts.fields_as_sections(rows, ["role", "said"])
    got = {(r.k, r.section): (r.start, r.end, r.n_tokens) for r in token_counts.section_tokens(
        given, PATH, PATTERN, key="k", sections="sections").collect()}
    assert got[1, 0][:2] == (0, 4) and got[1, 1][:2] == (5, 16) and got[2, 1] == (1, 1, 0)
    assert got[None, 1][:2] == (2, 6) and got[1, 0][2] == 1


def test_edge_rows_and_wrong_sections(spark):
    docs = spark.createDataFrame([(1, None, 7), (1, "", 8), (2, "a\n\nb\n", 9)], "doc_id long, text string, section int")
    got = sorted((r.doc_id, r.section, r.start, r.end) for r in token_counts.section_tokens(docs, PATH, PATTERN).collect())
    assert got == [(1, 0, 0, 0), (1, 0, 0, 0), (2, 0, 0, 2), (2, 1, 2, 3), (2, 2, 3, 5)]
    assert token_counts.section_tokens(docs.limit(0), PATH, PATTERN).collect() == []
    with pytest.raises(ValueError):
        token_counts.section_tokens(docs, PATH, PATTERN, rule="last")


def test_very_long_words(spark):
    docs = spark.createDataFrame([(1, "x" * 200_000), (2, "ab " * 100_000)], "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts.section_tokens(docs, PATH, PATTERN).collect()}
    coder, _ = token_counts.encoding(PATH, PATTERN)
    assert got == {1: len(coder.encode_ordinary("x" * 200_000)), 2: len(coder.encode_ordinary("ab " * 100_000))}
