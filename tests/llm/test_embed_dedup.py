"""Vector links against all cosines."""

import numpy as np
import pytest

from feedback_loom.llm import embed_dedup, queries


def by_hand(rows, threshold=0.95):
    sound = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and len(v) and all(
        x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)]
    parent = {i: i for i, _ in sound}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = dict.fromkeys(range(len(sound)), 0)
    for a, (i, x) in enumerate(sound):
        for b, (j, y) in enumerate(sound):
            x1, y1 = x / np.abs(x).max(), y / np.abs(y).max()
            if a != b and len(x) == len(y) and (x1 @ y1) / np.sqrt((x1 @ x1) * (y1 @ y1)) >= threshold:
                links[a] += 1
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    found = [(i, links[a], root(i)) for a, (i, _) in enumerate(sound)]
    known = {id(v) for _, v in rows}
    return found, known


def result(spark, rows, **rest):
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, id int")
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in embed_dedup.near_vectors(frame, **rest).collect()), key=str)


@pytest.mark.parametrize("tile", [16, 4096])
def test_links_and_components_equal_all_cosines(spark, monkeypatch, tile):
    monkeypatch.setattr(embed_dedup, "TILE", tile)
    rng = np.random.default_rng(0)
    base = rng.normal(size=(12, 40))
    rows = [(i, (base[i % 12] + rng.normal(size=40) * rng.choice([0.0, 0.1, 0.2, 0.3])).tolist()) for i in range(140)]
    rows += [(200 + i, (rng.normal(size=3)).tolist()) for i in range(20)] + [(300, rows[5][1]), (301, [2 * x for x in rows[5][1]])]
    assert result(spark, rows) == sorted(by_hand(rows)[0], key=str)


def test_unsound_vectors_link_with_nothing(spark):
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
            (7, [1.0, 1.0]), (8, [1.0, 1.0]), (9, [1e-200, 1e-200]), (10, [1.0, 1.0, 0.0]), (11, [-1.0, -1.0])]
    got = {i: (n, c) for i, n, c in result(spark, rows)}
    assert all(got[i] == (0, i) for i in (1, 2, 3, 4, 5, 6, 10, 11)) and all(got[i] == (2, 7) for i in (7, 8, 9))
    assert result(spark, [(None, [1.0]), (1, [1.0])]) == [(1, 0, 1), (None, 0, None)]
    assert result(spark, []) == [] and result(spark, [(5, [3.0])]) == [(5, 0, 5)]


def test_bounds_never_lose_a_pair():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 64))
    x[150:] = x[:150] + rng.normal(size=(150, 64)) * 0.3
    q, _ = np.linalg.qr(rng.normal(size=(64, 64)))
    tile = embed_dedup.Tile(np.arange(300).tobytes(), np.ones(300, np.int64).tobytes(), np.full(300, 64, np.int32).tobytes(), x.tobytes(), q)
    got = {(int(a), int(b)) for i, j in embed_dedup.links_between(tile, tile, 0.95, True) for a, b in zip(i, j)}
    u = embed_dedup.unit(x)
    assert got == {(a, b) for a, b in zip(*np.nonzero(np.triu(u @ u.T >= 0.95, 1)))} and got


def test_whole_table_equals_all_cosines(spark, folder):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in queries.op8_embedding_near_dedup(spark, folder).collect())
    assert got == sorted(by_hand(rows)[0])
