import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from roamgrid.llm import embedding_forest as forest  # noqa: E402
from roamgrid.llm import knn_join  # noqa: E402

SCHEMA = "vec_id long, embedding array<float>, label int, score double"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], label, 0.0)
                                  for i, v, label in rows], SCHEMA)


def clusters(seed, count=60, size=8, spread=0.03, dims=24):
    rng = np.random.default_rng(seed)
    out = []
    for c in range(count):
        center = rng.normal(size=dims)
        center /= np.linalg.norm(center)
        for _ in range(rng.integers(1, size)):
            out.append((len(out), (center + rng.normal(size=dims) * spread * rng.uniform(0.3, 2)).astype(np.float32), c % 3))
    return out


def all_pairs(rows, limit=0.93):
    x = np.array([v for _, v, _ in rows], dtype=np.float64)
    norms = np.linalg.norm(x, axis=1)
    labels = np.array([c for *_, c in rows])
    near = ((x @ x.T) / np.outer(norms, norms) >= limit) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(near, False)
    root = np.arange(len(rows))
    while True:
        least = np.minimum(root, np.where(near, root[None, :], len(rows)).min(1))
        if (least == root).all():
            return near.sum(1), root
        root = least


@pytest.mark.parametrize("block", [2048, 7])
def test_forest_recall_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(forest, "LEAF", 40)
    monkeypatch.setattr(forest, "LEAST_LEAF", 40)
    monkeypatch.setattr(forest, "BLOCK", block)
    rows = clusters(1, 200)
    links, root = all_pairs(rows)
    got = {r["vec_id"]: r for r in forest.near_duplicates(table(spark, rows)).collect()}
    found = np.array([got[i]["n_links"] for i in range(len(rows))])
    assert (found <= links).all() and found.sum() >= 0.98 * links.sum()
    same = np.array([got[i]["component_id"] for i in range(len(rows))]) == root
    assert same.mean() >= 0.98
    assert all(r["kept"] == (r["component_id"] == i) for i, r in got.items())


def test_large_leaves_are_split_by_trees_of_their_own(spark, monkeypatch):
    """Trees of few sampled rows leave large leaves; these are split twice, pairs are found as before, and a crowd ends the splitting."""
    for name, value in {"SAMPLE": 60, "LEAF": 30, "LEAST_LEAF": 20, "BLOCK": 60, "LEAF_SAMPLE": 40, "LEAF_PART": 50}.items():
        monkeypatch.setattr(forest, name, value)
    rng = np.random.default_rng(7)
    rows = clusters(6, 400, size=6)
    crowd = np.eye(24)[0]
    rows += [(len(rows) + i, (crowd + rng.normal(size=24) * 1e-3).astype(np.float32), 1) for i in range(150)]
    levels, fit = [], forest.materialize
    monkeypatch.setattr(forest, "materialize", lambda df, name: levels.append(name) or fit(df, name))
    links, root = all_pairs(rows)
    got = {r["vec_id"]: r for r in forest.near_duplicates(table(spark, rows)).collect()}
    found = np.array([got[i]["n_links"] for i in range(len(rows))])
    assert levels.count("split") >= 2
    assert (found <= links).all() and found.sum() >= 0.98 * links.sum()
    assert found[-150:].tolist() == links[-150:].tolist()
    assert (np.array([got[i]["component_id"] for i in range(len(rows))]) == root).mean() >= 0.95


def test_labels_of_any_size(spark, monkeypatch):
    """Labels outside the sample, also those near the ends of 64 bits, are kept apart."""
    ends = [2**62, -(2**62), 2**63 - 1, -(2**63)]
    rows = [(10 * i + j, [1.0, 0.01 * j], label) for i, label in enumerate(ends) for j in range(3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long")
    monkeypatch.setattr(forest, "SAMPLE", 1)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in forest.near_duplicates(df).collect()}
    assert got == {10 * i + j: (2, 10 * i) for i in range(4) for j in range(3)}


def test_a_crowd_of_copies_is_counted_whole(spark):
    rows = clusters(2, 20)
    crowd = rows[0][1]
    rows += [(1000 + i, crowd, rows[0][2]) for i in range(300)]
    links, _ = all_pairs(rows)
    got = {r["vec_id"]: r for r in forest.near_duplicates(table(spark, rows)).collect()}
    assert [got[i]["n_links"] for i, *_ in rows] == links.tolist()
    assert {got[i]["component_id"] for i in range(1000, 1300)} == {0}


def test_forest_awkward_rows(spark):
    one = [1.0, 0.0, 0.0]
    rows = [(1, one, 5), (2, one, 5), (3, one, None), (4, None, 5), (5, [0, 0, 0], 5), (6, [1, None, 0], 5), (7, [1, float("nan"), 0], 5),
            (8, [1, float("inf"), 0], 5), (9, [2.0], 5), (10, one, -5), (11, [], 5), (None, one, 5), (2, one, 5)]
    got = {}
    for r in forest.near_duplicates(table(spark, rows)).collect():
        got.setdefault(r["vec_id"], []).append(r)
    assert [len(got[i]) for i in (1, 2, None)] == [1, 2, 1]
    assert {i: (got[i][0]["n_links"], got[i][0]["component_id"]) for i in (1, 2, 9)} == {1: (3, 1), 2: (3, 1), 9: (3, 1)}
    assert all((got[i][0]["n_links"], got[i][0]["component_id"], got[i][0]["kept"]) == (0, i, True) for i in (3, 4, 5, 6, 7, 8, 10, 11))
    assert got[None][0]["component_id"] is None and not got[None][0]["kept"]
    assert forest.near_duplicates(table(spark, [])).count() == 0


def brute(rows, every=50, k=5):
    x = np.floor(np.array([v for _, v, _ in rows], dtype=np.float64) * 256).astype(np.int64)
    ids = np.array([i for i, *_ in rows])
    out = {}
    for i in range(len(rows)):
        if ids[i] % every == 0:
            scores = x @ x[i]
            order = [j for j in np.lexsort((ids, -scores)) if j != i][:k]
            out[ids[i]] = [(ids[j], scores[j]) for j in order]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


@pytest.mark.parametrize("rows_per_task", [20_000, 40])
def test_join_is_exact(spark, monkeypatch, rows_per_task):
    monkeypatch.setattr(knn_join, "ROWS_PER_TASK", rows_per_task)
    monkeypatch.setattr(knn_join, "QUERIES_PER_TASK", 3)
    rows = clusters(3, 150) + [(10_000 + 25 * i, np.full(24, 0.2, dtype=np.float32) * (1 + i % 2), 0) for i in range(40)]
    assert answers(knn_join.search(table(spark, rows))) == brute(rows)


def test_bounds_prune_far_cells(spark):
    """Three far groups: rows go to their own group only, and the answers are still right."""
    pivots = np.array([[0.0, 0.0], [100.0, 0.0], [0.0, 100.0]])
    limit = knn_join.bounds(pivots, {0: 1.0, 2: 2.0}, {j: [0.0, 1.0, 2.0] for j in range(3)}, 3)
    assert 4 <= limit[0] < 5 and 6 <= limit[2] < 7
    assert knn_join.bounds(pivots, {0: 1.0}, {0: [0.5]}, 3)[0] == float("inf")


def test_join_awkward_rows(spark):
    rows = [(0, [1, 1], 1), (50, [1, 1], 1), (7, [1, 1], None), (8, None, 1), (9, [1, None], 1), (10, [float("nan"), 1], 1), (100, [-1, 0], 1),
            (None, [1, 1], 1), (11, [2], 1), (150, [float("inf"), 1], 1), (0, [1, 1], 1)]
    got = answers(knn_join.search(table(spark, rows)))
    assert set(got) == {0, 50, 100}
    assert [i for i, _ in got[0]] == [7, 11, 50, 100] and [i for i, _ in got[50]] == [0, 7, 11, 100]
    assert [s for _, s in got[0]] == [131072, 131072, 131072, -65536]
    assert got[100] == [(0, -65536), (7, -65536), (50, -65536), (11, -131072)]
    assert knn_join.search(table(spark, [])).count() == 0
    assert knn_join.search(table(spark, [(50, [1, 2], 1)])).count() == 0
