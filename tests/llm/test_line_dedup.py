"""Line dedup: alignment, deletion and edge cases."""

from pathlib import Path

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from feedback_loom.llm import columns, line_dedup, queries
from feedback_loom.session import recorded_scratch, to_table

PASSAGE = "\n".join(" ".join(f"p{i}{j}" for j in range(12)) + "." for i in range(5))


def words(n, tag):
    return " ".join(f"{tag}{i}" for i in range(n)) + "."


def cleaned(spark, rows, **rest):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id: r for r in line_dedup.deduplicated(docs, **rest).collect()}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 12), max_size=40), st.lists(st.integers(0, 12), max_size=40))
def test_alignment_matches_equal_lines_once_and_all_of_them(a, b):
    found = line_dedup.patience(a, b)
    assert all(a[i] == b[j] for i, j in found)
    assert len({i for i, _ in found}) == len({j for _, j in found}) == len(found)
    assert len(found) == sum(min(a.count(x), b.count(x)) for x in set(a))


def test_unique_lines_in_order_are_anchors():
    assert line_dedup.patience([1, 2, 3, 9, 4], [1, 3, 9, 5, 4]) == [(0, 0), (2, 1), (3, 2), (4, 4)]


def test_a_passage_leaves_all_documents_but_the_first(spark):
    rows = [(i, words(15, f"a{i}_") + "\n" + PASSAGE + "\n" + words(15, f"b{i}_")) for i in (4, 2, 9)]
    got = cleaned(spark, rows)
    assert got[2].text == dict(rows)[2] and got[2].removed_spans == []
    for i in (4, 9):
        assert "p00" not in got[i].text and f"a{i}_0" in got[i].text and f"b{i}_14" in got[i].text
        assert got[i].removed_spans == [[1, 6]] and got[i].n_removed == 5


def test_a_passage_inside_a_line_is_found(spark):
    inside = PASSAGE.replace("\n", " ")
    got = cleaned(spark, [(1, words(20, "x") + " " + inside + " " + words(20, "y")), (2, words(9, "u") + " " + inside + " " + words(9, "v"))])
    assert got[2].text.split() == (words(9, "u") + " " + words(9, "v")).split()


def test_moved_blocks_are_found(spark):
    one, two = words(40, "m"), words(40, "n")
    got = cleaned(spark, [(1, f"{one}\n{two}\n{words(5, 'k')}"), (2, f"{two}\n{words(8, 'z')}\n{one}")])
    assert got[2].text == words(8, "z") + "\n"


def test_short_shared_lines_stay(spark):
    rows = [(i, f"All rights reserved by us.\n{words(30, f'q{i}')}") for i in range(6)]
    assert all(r.text == t for (_, t), r in zip(rows, (cleaned(spark, rows)[i] for i in range(6))))


def test_blocks_of_short_lines_are_found(spark):
    verse = "\n".join(f"v{i}a v{i}b v{i}c" for i in range(20))
    shouted = " ".join(f"s{i}!" for i in range(40))
    long = words(35, "g")
    rows = [(1, f"{words(9, 'a')}\n{verse}\n{words(9, 'b')}"), (2, shouted), (3, f"{long}\ntwo words\n{words(9, 'e')}"),
            (4, f"{words(9, 'c')}\n{verse}\n{words(9, 'd')}"), (5, f"{words(9, 'f')} {shouted.upper()}"), (6, long),
            (7, f"{words(9, 'h')}\n{long}\ntwo words\n{words(9, 'i')}"), (8, verse)]
    got = cleaned(spark, rows)
    assert all(got[i].text == dict(rows)[i] for i in (1, 2, 3))
    assert got[4].text == f"{words(9, 'c')}\n{words(9, 'd')}" and got[4].removed_spans == [[1, 21]]
    assert got[5].text == f"{words(9, 'f')} " and got[5].removed_spans == [[1, 41]]
    assert got[7].text == f"{words(9, 'h')}\n{words(9, 'i')}" and got[6].text == got[8].text == ""


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(1, 7), max_size=9), max_size=4))
def test_runs_of_short_lines_stay_in_their_text_and_are_the_shortest(texts):
    sizes, text = np.array([n for x in texts for n in x], int), np.repeat(np.arange(len(texts)), [len(x) for x in texts])
    hashes = np.arange(len(sizes), dtype=np.uint64)
    runs, of_runs = line_dedup.runs_of(hashes, sizes, text)
    spans = set()
    for i in np.flatnonzero(sizes < line_dedup.RARE_WORDS).tolist():
        own = np.flatnonzero(text == text[i]).tolist()
        spans |= {next(((i, j + 1) for j in own if j >= i and sizes[i:j + 1].sum() >= line_dedup.RARE_WORDS), None),
                  next(((j, i + 1) for j in own[::-1] if j <= i and sizes[j:i + 1].sum() >= line_dedup.RARE_WORDS), None)}
    spans = sorted(spans - {None})
    assert of_runs.tolist() == [text[a] for a, _ in spans] and len(set(runs.tolist())) == len(spans)


def test_passages_that_begin_and_end_inside_lines_go(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(1, f"one two {passage} three {words(9, 'a')}"), (2, f"{words(9, 'b')} Four {passage.upper()} five six.\n{words(9, 'c')}"),
            (3, passage), (4, words(70, "d")), (5, words(70, "d").replace("d9 ", "e ").replace("d60 ", "e ")), (6, f"x {words(12, 'p')}")]
    got = cleaned(spark, rows)
    assert all(got[i].text == dict(rows)[i] and got[i].n_removed == 0 for i in (1, 4, 6))
    assert got[2].text == f"{words(9, 'b')} Four five six.\n{words(9, 'c')}" and got[2].removed_spans == [[1, 2]]
    assert got[3].text == "" and got[3].n_removed == 1
    assert got[5].text.split() == [*(f"d{i}" for i in range(9)), "e", "e", *(f"d{i}" for i in range(61, 69)), "d69."]
    assert {r.doc_id for r in line_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == {1, 2, 4, 5, 6}


def test_no_50_words_of_an_earlier_document_stay(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts, earlier, held = {r.doc_id: r.text.encode().lower().split() for r in docs.collect()}, set(), {}
    for key in sorted(texts):
        own = texts[key]
        held[key] = {tuple(own[i:i + 50]) for i in range(len(own) - 49)} & earlier
        earlier |= {tuple(own[i:i + 50]) for i in range(len(own) - 49)}
    assert any(held.values())
    for row in line_dedup.deduplicated(docs).collect():
        kept = row.text.encode().lower().split()
        assert not {tuple(kept[i:i + 50]) for i in range(len(kept) - 49)} & held[row.doc_id]
        assert len(kept) == len(texts[row.doc_id]) if row.n_removed == 0 else len(kept) <= len(texts[row.doc_id]) - 30


def test_picked_runs_leave_no_gap():
    hashes = np.random.default_rng(0).integers(0, 2 ** 63, 400).astype(np.uint64)
    runs = line_dedup.word_runs(hashes, 30)
    at = np.flatnonzero(np.isin(runs, line_dedup.picked(runs)))
    assert len(runs) == 371 and np.diff(at).max() <= line_dedup.SPREAD and at[0] < line_dedup.SPREAD
    assert line_dedup.word_runs(hashes[7:60], 30).tolist() == runs[7:31].tolist()
    assert len(line_dedup.picked(runs[:3])) == 1 and len(line_dedup.picked(runs[:0])) == 0


def test_edge_rows_keep_their_columns(spark):
    docs = spark.createDataFrame(
        [(1, None, "u", 1), (2, "", "v", 2), (3, "\n \n", "w", 3), (None, PASSAGE, "x", 4), (4, PASSAGE, "y", 5),
         (4, PASSAGE, "z", 6), (5, PASSAGE, None, 7)], "doc_id long, text string, id string, places int")
    got = {r.places: r for r in line_dedup.deduplicated(docs).collect()}
    assert got[1].text is None and got[2].text == "" and got[3].text == "\n \n"
    assert got[4].text == PASSAGE and got[5].text == PASSAGE and got[6].text == PASSAGE
    assert got[7].text == "" and got[7].id is None
    assert {r.places for r in line_dedup.without_repeats(docs).collect()} == {1, 2, 3, 4, 5, 6}
    assert line_dedup.deduplicated(docs.limit(0)).collect() == []


def naive(rows):
    """The same rule without hashes: a run of lines of 30 words or more that earlier documents hold all goes."""
    import re

    def lines(text):
        found = []
        for part in (text or "").split("\n"):
            for one in re.findall(r"(?:\S*[^\s.!?]\s+|\S*[^\s.!?]$)*(?:\S*[.!?](?:\s+|$))?", part):
                if one.split():
                    found.append(tuple(one.encode().lower().split()))
        return found

    return {key: lines(text) for key, text in rows}


def is_subsequence(few, many):
    rest = iter(many)
    return all(x in rest for x in few)


def test_whole_table_against_all_pairs(spark, folder):
    """What goes was held by earlier documents, as lines or runs of words; no run of 50 words that one holds stays whole."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    lines, seen, runs = naive(docs.items()), {}, {n: {} for n in (30, 50)}
    words = {key: [w for line in lines[key] for w in line] for key in lines}
    for key in sorted(lines):
        for line in lines[key]:
            seen.setdefault(line, key)
        for n, held in runs.items():
            for i in range(len(words[key]) - n + 1):
                held.setdefault(tuple(words[key][i:i + n]), key)
    removed = 0
    for row in queries.op1_line_dedup(spark, folder).collect():
        key, own = row.doc_id, words[row.doc_id]
        assert (row.n_removed == 0) == (row.text == docs[key])
        may_go = [seen[line] < key for line in lines[key] for _ in line]
        for i in range(len(own) - 29):
            if runs[30][tuple(own[i:i + 30])] < key:
                may_go[i:i + 30] = [True] * 30
        kept = (row.text or "").encode().lower().split()
        assert is_subsequence(kept, own) and is_subsequence([w for w, gone in zip(own, may_go) if not gone], kept)
        removed += len(own) - len(kept)
        text = b" " + b" ".join(kept) + b" "
        for i in range(len(own) - 49):
            run = tuple(own[i:i + 50])
            assert runs[50][run] == key or b" " + b" ".join(run) + b" " not in text, (key, i)
    assert removed > 0


def test_reversed_lines_are_aligned_in_time():
    n = 100_000
    found = line_dedup.patience(list(range(n)), list(range(n))[::-1])
    assert len(found) == n and all(i + j == n - 1 for i, j in found)


def test_common_lines_and_first_documents_are_dealt(spark, monkeypatch):
    rows = [(i, f"{PASSAGE}\nown words of document number {i} stand here and nowhere else at all") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    plain = {tuple(r) for r in line_dedup.deduplicated(docs).select("doc_id", "text", "n_removed").collect()}
    monkeypatch.setattr(line_dedup, "HOT_LINE", 5)
    monkeypatch.setattr(columns, "DEALT", 7)
    assert {tuple(r) for r in line_dedup.deduplicated(docs).select("doc_id", "text", "n_removed").collect()} == plain
    assert sum(n > 0 for _, _, n in plain) == 59


def test_clashing_names_give_way(spark):
    docs = spark.createDataFrame([(1, PASSAGE, 7, "a", "b"), (2, PASSAGE, 8, "c", "d")],
                                 "doc_id long, text string, N_REMOVED int, _places string, `od.d` string")
    got = {r.doc_id: r for r in line_dedup.deduplicated(docs).collect()}
    assert got[2].n_removed == 5 and got[2]["od.d"] == "d" and len(got[2]) == 5
    kept = line_dedup.without_repeats(docs)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [(1, PASSAGE, 7, "a", "b")]


def test_pairs_join_each_document_with_the_first_holders(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT_LINE", 2)
    rng = np.random.default_rng(0)
    ids = [-2 ** 63, 2 ** 63 - 1, *rng.integers(-2 ** 40, 2 ** 40, 60).tolist()]
    texts = [" ".join(f"w{n}a w{n}b w{n}c." + f" x{n} y{n} z{n} u{n} v{n}!" * (n % 2) for n in rng.integers(0, 30, 6).tolist()) for _ in ids]
    rows = [*zip(ids, texts), (ids[5], texts[6]), (ids[7], None), (None, texts[8])]
    held, pairs = {}, {}
    for i, text in rows:
        lines, _, picks, _ = next(line_dedup._keys_in(pa.array([text]), 8))
        for by_words, keys in ((False, lines), (True, picks)):
            for x in set(keys.tolist()) if i is not None else ():
                held.setdefault((by_words, x), set()).add(i)
    for (by_words, _), found in held.items():
        for i in found - {min(found)}:
            pairs[i, min(found)] = by_words or pairs.get((i, min(found)), False)
    for parts in (1, 5):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        assert {(r.id, r["first"]): r.by_words for r in line_dedup.paired(docs, picks_of=8).collect()} == pairs
    assert any(pairs.values()) and len(held) > 100


def test_written_tables_are_small_beside_the_input(spark, tmp_path):
    rng = np.random.default_rng(0)
    texts = [" ".join(f"w{n}" + "." * (n % 9 == 0) for n in rng.integers(0, 10 ** 6, 250).tolist()) for _ in range(1000)]
    rows = [(i, text if i % 4 else texts[i - 1][:600] + " " + text) for i, text in enumerate(texts)]
    with recorded_scratch() as given:
        docs = to_table(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), "documents")
    with recorded_scratch() as paths:
        line_dedup.deduplicated(docs).write.parquet(str(tmp_path / "out"))
    size, written = (sum(f.stat().st_size for p in x for f in Path(p.removeprefix("file:")).rglob("*.parquet")) for x in (given, paths))
    assert spark.read.parquet(str(tmp_path / "out")).where("n_removed > 0").count() > 200 and 0 < written < size / 10
