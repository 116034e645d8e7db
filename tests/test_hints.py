"""Hints that ask for other groups; label sets from more descriptions than a prompt holds."""

import random
import re

import pytest
from pyspark.sql import functions as F

from feedback_loom import CallableBackend
from feedback_loom.functions import answers as A
from feedback_loom.operators import clusters, hints, labels
from feedback_loom.plans.analyze import choose_labels

SEP = A.ITEM_SEP


@pytest.mark.parametrize("hint, want", [
    ("merge a and b", [("merge", "a", "b")]),
    ("Please MERGE Größe_1 with b, split b from c; merge", [("merge", "größe_1", "b"), ("split", "b", "c")]),
    ("submerge a and b", []), ("", []), (None, []), ("fewer labels", []),
])
def test_wishes_are_read(spark, hint, want):
    rows = spark.createDataFrame([(1, hint)], "id int, hint string")
    assert [tuple(r)[2:] for r in hints.wished(rows).orderBy("no").collect()] == want


def top_of(spark, sets):
    return spark.createDataFrame([(g, t, i + 1) for g, terms in sets.items() for i, t in enumerate(terms)],
                                 "cluster int, term string, rn int")


def one_by_one(sets, must, apart, min_jaccard):
    """Links taken from the strongest down, each checked against every pair to be split."""
    root = {g: g for g in sets}

    def merge(a, b):
        low, high = sorted((root[a], root[b]))
        root.update({g: low for g in root if root[g] == high})

    for group in must:
        for g in group:
            merge(group[0], g)
    # a merged group on both sides of a wish is taken out of it
    bars = []
    for left, right in apart:
        lefts, rights = {root[g] for g in left}, {root[g] for g in right}
        bars.append(([g for g in left if root[g] not in rights], [g for g in right if root[g] not in lefts]))
    links = []
    for a in sets:
        for b in sets:
            shared = len(set(sets[a]) & set(sets[b]))
            jaccard = shared / (len(sets[a]) + len(sets[b]) - shared)
            if a < b and jaccard >= min_jaccard:
                links.append((-jaccard, a, b))
    for _, a, b in sorted(links):
        ends = {root[a], root[b]}
        if not any({root[x], root[y]} == ends for left, right in bars for x in left for y in right):
            merge(a, b)
    return root


@pytest.mark.parametrize("seed", range(4))
def test_rounds_equal_one_by_one(spark, seed):
    draw = random.Random(seed)
    sets = {g: draw.sample("abcdefgh", 4) for g in range(12)}
    must = [draw.sample(range(12), 3)] if seed % 2 else []
    apart = [(draw.sample(range(6), 2), draw.sample(range(6, 12), 2)) for _ in range(3)]
    ends = [(100, "merge", i % 2, g) for group in must for i, g in enumerate(group)]
    ends += [(n, "split", side, g) for n, wish in enumerate(apart) for side in (0, 1) for g in wish[side]]
    ends = spark.createDataFrame(ends, "no int, kind string, side int, group int")
    got, contradicted = hints.merge_as_wished(top_of(spark, sets), "cluster", ends, 0.33)
    assert {r.cluster: r.merged for r in got.collect()} == one_by_one(sets, must, apart, 0.33)
    held = {g for group in must for g in group}
    assert contradicted == any(held & set(left) and held & set(right) for left, right in apart)


def test_names_are_labels_or_terms(spark):
    top = top_of(spark, {1: ["room", "dirty"], 2: ["room", "loud"], 3: ["staff", "room"], 4: ["food", "cold"]})
    merged = spark.createDataFrame([(1, 1), (2, 1), (3, 3), (4, 4)], "cluster int, merged int")
    named = labels.two_term_labels(top, merged, "cluster")

    def found(hint):
        wishes = hints.wished(spark.createDataFrame([(hint,)], "hint string"))
        return sorted(tuple(r) for r in hints.sides(wishes, top, named, "cluster").collect())

    assert found("split room_dirty and food") == [(0, "split", 0, 1), (0, "split", 0, 2), (0, "split", 1, 4)]
    # cluster 3 has both terms and is on the side of its better one
    assert found("split room from staff") == [(0, "split", 0, 1), (0, "split", 0, 2), (0, "split", 1, 3)]
    assert found("merge loud with food, merge nothing and food") == [(0, "merge", 0, 2), (0, "merge", 1, 4)]
    assert found("split room and room") == []


def test_groups_kept_apart_get_names_of_their_own(spark):
    top = top_of(spark, {1: ["room", "dirty"], 2: ["room", "dirty"], 3: ["staff", "rude"]})
    merged = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "cluster int, merged int")
    shared = {r.cluster: r.label for r in labels.two_term_labels(top, merged, "cluster").collect()}
    assert shared == {1: "room_dirty", 2: "room_dirty", 3: "staff_rude"}
    own = {r.cluster: (r.label_id, r.label) for r in labels.two_term_labels(top, merged, "cluster", apart=True).collect()}
    assert own == {1: (1, "room_dirty"), 2: (2, "room_dirty_2"), 3: (3, "staff_rude")}


def summary_of(spark, n, missing=()):
    rows = [(i, None if i in missing else f"1.issue{i % 20}", None if i in missing else "1." + "why " * 30) for i in range(n)]
    return spark.createDataFrame(rows, "cluster int, issues string, reasons string")


def namer(log, limit):
    """Gives the issues and labels it finds in its prompt, each once; notes the length of each prompt."""
    def fn(instruction, prompts):
        out = []
        for prompt in prompts:
            with open(log, "a") as file:
                file.write(f"{len(prompt)}\n")
            if limit and "broken" in prompt:
                out.append("no list")
            else:
                found = list(dict.fromkeys(re.findall(r"issue\d+", prompt)))
                out.append(SEP.join(f"{i + 1}.{name}" for i, name in enumerate(found)))
        return out
    return fn


def proposed(spark, backend, summary):
    return choose_labels(backend, clusters.Clustering(summary, None, None, None, 1, None), summary, None)


def test_500_clusters_are_labelled_by_a_tree_of_bounded_prompts(spark, tmp_path):
    summary = summary_of(spark, 500, missing=(3, 7))
    one = proposed(spark, CallableBackend(namer(tmp_path / "one", 0), max_prompt=1_000_000), summary)
    tree = proposed(spark, CallableBackend(namer(tmp_path / "tree", 0), max_prompt=4_000), summary)
    assert sorted(one.names) == sorted(tree.names) and len(one.names) == 21 and one.names[-1] == A.FALLBACK_LABEL
    assert one.status == tree.status == "ok; without clusters 3, 7"
    sizes = [int(x) for x in (tmp_path / "tree").read_text().split()]
    assert max(sizes) <= 4_000 and len(sizes) > 10
    assert len((tmp_path / "one").read_text().split()) == 1


def test_descriptions_longer_than_a_prompt_are_read_whole(spark, tmp_path):
    text = " ".join(f"issue{i}" for i in range(400))
    summary = spark.createDataFrame([(0, text, "1.x"), (1, "issue3", "1.y")], "cluster int, issues string, reasons string")
    found = proposed(spark, CallableBackend(namer(tmp_path / "log", 0), max_prompt=1_000), summary)
    # more labels than a prompt holds: all of them stand (names cut between two pieces are names of their own)
    assert found.status == "labels_not_reduced"
    whole = {f"issue{i}" for i in range(400)}
    assert len(whole & set(found.names)) > 380
    assert max(int(x) for x in (tmp_path / "log").read_text().split()) <= 1_000


def test_parts_without_an_answer_are_named(spark, tmp_path):
    rows = [(i, "broken" if i < 8 else f"issue{i % 3}", "1." + "why " * 60) for i in range(16)]
    summary = spark.createDataFrame(rows, "cluster int, issues string, reasons string")
    found = proposed(spark, CallableBackend(namer(tmp_path / "log", 1), max_prompt=1_100, max_attempts=2), summary)
    assert set(found.names) == {"issue0", "issue1", "issue2", A.FALLBACK_LABEL}
    assert found.status.startswith("labels_not_reduced; without clusters 0, 1, 2, 3, 4, 5, 6, 7")
