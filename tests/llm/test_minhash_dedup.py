import random
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from edges import by_id, documents, many, words  # noqa: E402
from roamgrid.llm.components import components  # noqa: E402
from roamgrid.llm.minhash_dedup import connected, near_duplicates, possible  # noqa: E402
from roamgrid.llm.shared import WordHashes, shingle_set, text_words  # noqa: E402


def expected(texts, width, percent=80):
    """Smallest index reachable, by comparing all pairs of shingle sets of words."""
    def grams(text):
        ws = text_words(text)
        return {tuple(ws[i: i + width]) for i in range(max(1, len(ws) - width + 1))} if ws else set()
    sets = [grams(t) for t in texts]
    root = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= percent * len(a | sets[j]):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return root, [len(s) for s in sets]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    out, passage = [], words(99, 50)
    for family in range(6):
        base = words(family, 40 + 60 * family)
        for copy in range(12):
            changed = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 15)):
                changed[rng.randrange(len(base))] = f"n{rng.randrange(10**6)}"
            out.append(" ".join(changed))
    out += [" ".join(words(100 + i, 15) + passage + words(200 + i, rng.randrange(5, 40))) for i in range(30)]
    return out + ["", "  ", "a b", "A  b", "a b c", out[3], out[3].upper()] + out[:5]


@pytest.mark.parametrize("width", [4, 5])
def test_against_all_pairs(spark, texts, width):
    root, sizes = expected(texts, width)
    got = by_id(near_duplicates(many(spark, texts), width))
    assert [got[i][0]["component_id"] for i in range(len(texts))] == root
    assert [got[i][0]["n_shingles"] for i in range(len(texts))] == sizes
    assert all(got[i][0]["kept"] == (root[i] == i) for i in range(len(texts)))


def test_awkward_rows(spark):
    got = by_id(near_duplicates(documents(spark), 5))
    assert sum(map(len, got.values())) == 16
    assert {i: got[i][0]["component_id"] for i in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10)} == {
        1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6, 7: 7, 8: 7, 9: 9, 10: 10}
    assert [r["n_shingles"] for r in got[4] + got[5] + got[6] + got[7] + got[10]] == [0, 0, 0, 1, 1]
    assert len(got[11]) == 2 and all(r["component_id"] == 11 and r["kept"] for r in got[11])
    assert all(r["component_id"] is None and not r["kept"] for r in got[None])


def test_empty_table(spark):
    assert near_duplicates(documents(spark, []), 5).count() == 0


def test_sketches_keep_every_close_pair():
    rng, hashes = random.Random(1), WordHashes()
    sets = []
    for size in (20, 33, 80, 400):
        base = words(size, size, 10**6)
        for _ in range(25):
            text = [w if rng.random() > 0.02 else f"n{rng.random()}" for w in base]
            sets.append(shingle_set([w.encode() for w in text], hashes, 4))
    near = possible([s[:32] for s in sets], np.array([len(s) for s in sets]), 32)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = np.intersect1d(a, b).size
            if 100 * both >= 80 * (a.size + b.size - both):
                assert near[i, j] and near[j, i]
    roots = connected(sets, near, 80)
    assert (roots <= np.arange(len(sets))).all() and (roots[roots] == roots).all()


def test_blocks_of_a_large_group(spark, texts, monkeypatch):
    from roamgrid.llm import minhash_dedup

    monkeypatch.setattr(minhash_dedup, "BLOCK_ROWS", 5)
    root, _ = expected(texts, 5)
    got = by_id(near_duplicates(many(spark, texts), 5))
    assert [got[i][0]["component_id"] for i in range(len(texts))] == root


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200), (301, 300)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}, 300: 300, 301: 300}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_a_repeated_row_is_one_node_and_one_text(spark, monkeypatch):
    from roamgrid.llm import minhash_dedup

    base = words(1, 100)
    rows = [(1, " ".join(base))] * 300 + [(2, " ".join([*base[:-1], "other"]))] * 200 + [(3, "a b c d e f")] * 50
    seen, tasks = [], minhash_dedup._tasks
    monkeypatch.setattr(minhash_dedup, "_tasks", lambda rows: seen.append(rows.count()) or tasks(rows))
    got = by_id(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 5))
    assert {i: len(v) for i, v in got.items()} == {1: 300, 2: 200, 3: 50}
    assert {i: {(r["component_id"], r["kept"]) for r in v} for i, v in got.items()} == {1: {(1, True)}, 2: {(1, False)}, 3: {(3, True)}}
    assert seen == [2, 2]
