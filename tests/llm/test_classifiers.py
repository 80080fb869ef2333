import random
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from edges import by_id, documents, labels, words  # noqa: E402
from roamgrid.llm import quality_gam, toxicity_cnn  # noqa: E402
from roamgrid.llm.shared import table  # noqa: E402

SF = "/root/testdata/sf0.1"
JUDGES = {"quality": (quality_gam, 0.3), "toxic": (toxicity_cnn, 0.5)}


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.mark.parametrize("label", JUDGES)
def test_held_out_accuracy(spark, label):
    module, threshold = JUDGES[label]
    docs, marks = table(spark, SF, "documents"), table(spark, SF, "labels")
    rows = module.judge(docs, marks).join(marks, "doc_id").collect()
    assert all(r["held_out"] == held_out(r["doc_id"]) and r["predicted"] == (r["score"] >= threshold) for r in rows)
    kept = [r for r in rows if r["held_out"]]
    right = [np.mean([r["predicted"] == r[label] for r in kept if r[label] == c]) for c in (0, 1)]
    assert min(right) > 0.9, (label, right)


@pytest.mark.parametrize("label", JUDGES)
def test_awkward_rows(spark, label):
    module, _ = JUDGES[label]
    marks = labels(spark, [(1, 1, 0), (2, 0, 1), (3, 1, 1), (11, None, None), (12, 0, 0), (None, 1, 1), (99, 1, 1), (7, 5, 5)])
    got = by_id(module.judge(documents(spark), marks))
    assert sum(map(len, got.values())) == 16 and all(0 <= r["score"] <= 1 for rs in got.values() for r in rs)
    assert got[4][0]["score"] == got[5][0]["score"] == got[6][0]["score"]
    assert got[11][0] == got[11][1] and got[None][0]["held_out"]


@pytest.mark.parametrize("label", JUDGES)
def test_empty_tables_and_one_class(spark, label):
    module, _ = JUDGES[label]
    assert module.judge(documents(spark, []), labels(spark)).count() == 0
    assert {r["score"] for r in module.judge(documents(spark), labels(spark)).collect()} == {0.5}
    one = module.judge(documents(spark), labels(spark, [(i, 1, 1) for i in range(1, 13)]))
    assert all(r["score"] > 0.5 for r in one.collect())


def test_tables_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.fit(x[:2000], y[:2000], pairs=3)
    assert np.mean((model.score(x[2000:]) > 0.5) == y[2000:]) > 0.95
    assert {tuple(sorted(p[:2])) for p in model.pairs[:1]} == {(0, 1)}


def test_pooling_is_the_largest_response_over_the_whole_text():
    rng, buckets, model = random.Random(0), toxicity_cnn.Buckets(), toxicity_cnn.untrained(1)
    texts = [[buckets[w] for w in words(rng.random(), n)] for n in (1, 2, 3, 50, 4000)]
    got = model.pooled([np.array(t) for t in texts])[0]

    def vector(word):
        return model.embeddings[word // toxicity_cnn.BUCKETS] + model.embeddings[word % toxicity_cnn.BUCKETS]

    for row, text in zip(got, texts):
        padded = [vector(w) for w in text] + [np.zeros(toxicity_cnn.DIMENSIONS)] * 2
        k, want = 0, []
        for width in toxicity_cnn.WIDTHS:
            parts = model.filters[k: k + width]
            k += width
            want += list(np.max([sum(padded[i + o] @ parts[o] for o in range(width)) for i in range(len(text))], axis=0))
        assert np.allclose(row, want, atol=1e-4)


def test_every_labelled_row_is_learned_from(spark):
    rng = random.Random(3)
    texts = {i: [f"{'bad' if i % 4 == 0 else 'good'}{i % 60}", *words(i, 12, 60)] for i in range(1, 1201)}
    for own in texts.values():
        rng.shuffle(own)
    docs = documents(spark, [(i, " ".join(t), "en", "a", 0, 0.0, "", "") for i, t in texts.items()])
    marks = labels(spark, [(i, 1, int(i % 4 == 0)) for i in texts] + [(1, 1, 0)])
    model = toxicity_cnn.train(docs, marks, max_rows=150, max_words=3000)
    kept = {r["doc_id"] for r in docs.filter("pmod(xxhash64(doc_id), 4) = 0").collect()}
    seen = {}
    for i in texts:
        for word in set(texts[i]) if i not in kept and not held_out(i) else ():
            seen[word] = seen.get(word, 0) + 1
    often, buckets = [w for w, n in seen.items() if n >= 4], toxicity_cnn.Buckets()
    assert len(often) > 100 and all(model.embeddings[buckets[w] // toxicity_cnn.BUCKETS].any() for w in often)
    unseen = [i for i in texts if held_out(i)]
    scores = model.score([np.array([buckets[w] for w in texts[i]]) for i in unseen])
    assert np.mean((scores > 0.5) == [i % 4 == 0 for i in unseen]) > 0.95


def test_different_texts_of_a_word_are_counted_over_all_shards():
    rng = np.random.default_rng(0)
    texts = [rng.integers(0, 300, 5) for _ in range(200)]
    texts += texts[:50]
    prints = np.array([hash(t.tobytes()) for t in texts])
    shard = rng.integers(0, 5, len(texts))
    found = toxicity_cnn._in_enough(np.stack([toxicity_cnn._least_prints([t for t, s in zip(texts, shard) if s == n], prints[shard == n], 4)
                                              for n in range(5)]))
    want = np.zeros(toxicity_cnn.BUCKETS, dtype=int)
    for t in {t.tobytes(): t for t in texts}.values():
        want[np.unique(np.concatenate([t // toxicity_cnn.BUCKETS, t % toxicity_cnn.BUCKETS]))] += 1
    assert (found == (want >= 4)).all() and 0 < found.sum() < 300


def test_draws_take_every_row():
    group = np.arange(10, 17)
    drawn = np.concatenate([toxicity_cnn._drawn(group, start, 4, [1, 2]) for start in range(0, 28, 4)])
    assert all(sorted(drawn[i:i + 7]) == list(group) for i in range(0, 28, 7)) and len({tuple(drawn[i:i + 7]) for i in range(0, 28, 7)}) > 1


def test_thresholds_divide_the_classes():
    assert toxicity_cnn._best_threshold(np.array([0.1, 0.2, 0.8, 0.9]), np.array([0, 0, 1, 1])) == pytest.approx(0.5)
    assert toxicity_cnn._best_threshold(np.array([0.1]), np.array([1])) is None


def cuts(g, h, depth, l2):
    """Values by bin of the greedy tree, each cut tried one after another."""
    best, at = sum(g) ** 2 / (sum(h) + l2) + 1e-9, None
    for k in range(1, len(g)) if depth else ():
        gain = sum(g[:k]) ** 2 / (sum(h[:k]) + l2) + sum(g[k:]) ** 2 / (sum(h[k:]) + l2)
        if gain > best:
            best, at = gain, k
    if at is None:
        return [sum(g) / (sum(h) + l2)] * len(g)
    return cuts(g[:at], h[:at], depth - 1, l2) + cuts(g[at:], h[at:], depth - 1, l2)


def test_leaves_are_those_of_the_best_cuts():
    rng = np.random.default_rng(5)
    for size in (1, 2, 3, 9, 32):
        for depth in (0, 1, 2, 3):
            g, h = rng.normal(size=size), rng.uniform(0.01, 1, size)
            assert np.allclose(quality_gam._leaves(g, h, depth, 2.0), cuts(list(g), list(h), depth, 2.0))
    assert np.allclose(quality_gam._leaves(np.zeros(4), np.zeros(4), 2, 2.0), 0)


def test_grids_are_cut_where_the_gain_is_greatest():
    rng = np.random.default_rng(6)
    for _ in range(20):
        g, h = rng.normal(size=(8, 8)), rng.uniform(0.01, 1, (8, 8))

        def parts(r, c):
            return [(slice(*a), slice(*b)) for a in ((0, r), (r, 8)) for b in ((0, c), (c, 8))]

        gain, r, c = max((sum(g[p].sum() ** 2 / (h[p].sum() + 2.0) for p in parts(r, c)), r, c) for r in range(1, 8) for c in range(1, 8))
        want = np.zeros((8, 8))
        for p in parts(r, c):
            want[p] = g[p].sum() / (h[p].sum() + 2.0)
        found, values = quality_gam._grid_leaves(g, h, 2.0)
        assert np.isclose(found, gain - g.sum() ** 2 / (h.sum() + 2.0)) and np.allclose(values, want)


def test_scores_are_sums_of_table_entries():
    """One row at a time: the bin of each feature by counting edges, the entry of each table and grid, the logistic of the sum."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 5)).round(1)
    y = (x[:, 0] * x[:, 1] + x[:, 2] > 0).astype(float)
    model = quality_gam.fit(x, y, bins=16, rounds=30, pairs=4)
    for row, score in zip(x[:100], model.score(x[:100])):
        at = [sum(edge <= v for edge in edges) for v, edges in zip(row, model.edges)]
        total = model.intercept + sum(values[b] for values, b in zip(model.tables, at))
        for i, j, grid in model.pairs:
            total += grid[at[i] * 8 // len(model.tables[i]), at[j] * 8 // len(model.tables[j])]
        assert np.isclose(score, 1 / (1 + np.exp(-total)))
    assert ((model.score(x) > 0.5) == y).mean() > 0.9
