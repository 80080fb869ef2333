import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from edges import by_id, documents, many, same, words  # noqa: E402
from roamgrid.llm import mixing, packing  # noqa: E402


def shares(sizes, weights, budget=1.5, most=2):
    """Targets by repeated resharing: what is above a cap goes to the others by weight."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, target = budget * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if most * sizes[s] <= level * weight[s] + 1e-9}
        if not over:
            return target | {s: level * weight[s] for s in open_}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= over
    return target


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(2)
    texts = [" ".join(words(i, rng.randrange(1, 60))) for i in range(400)]
    names = ["big"] * 5 + ["a", "b", "é", None, "z"]
    return many(spark, texts, lambda i: names[i % 10])


def test_targets_and_taken(spark, mixed):
    rows = mixing.curriculum(mixed).collect()
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    want = shares(sizes, mixing.WEIGHTS)
    for s in sizes:
        own = [r for r in rows if r["source"] == s]
        assert own[0]["source_size"] == sizes[s] and own[0]["target"] == pytest.approx(want[s])
        assert abs(sum(r["size"] * r["copies"] for r in own) - want[s]) <= 60
        assert all(0 <= r["copies"] <= 2 and len(r["positions"]) == r["copies"] for r in own)
    assert same(mixing.curriculum(mixed), mixing.curriculum(mixed))


def test_positions_invert_the_schedule(spark):
    """The share of a schedule's area up to the position of a share is that share."""
    for s, knots in enumerate(mixing.SCHEDULES):
        got = spark.range(0, 100).selectExpr("id / 100D AS u").selectExpr(
            "u", f"{mixing.progress_sql('u', str(s))} AS t").collect()
        area = sum((a + b) / 2 for a, b in zip(knots, knots[1:])) / (len(knots) - 1)
        for r in got:
            steps = 4000
            width = r["t"] / steps
            at = [(i + 0.5) * width * (len(knots) - 1) for i in range(steps)]
            inside = sum((knots[int(x)] + (knots[int(x) + 1] - knots[int(x)]) * (x - int(x))) * width for x in at)
            assert inside / area == pytest.approx(r["u"], abs=1e-5)


def test_mixture_repeats_and_sorts(spark, mixed):
    plan = {r["doc_id"]: r["copies"] for r in mixing.curriculum(mixed).collect()}
    out = mixing.mix(mixed)
    rows = by_id(out)
    assert out.columns == mixed.columns and {i: len(rows.get(i, [])) for i in plan} == plan


def test_documents_are_counted_in_the_mix(spark, mixed, monkeypatch):
    for docs in (mixed, documents(spark)):
        plan = mixing.curriculum(docs).selectExpr(
            "doc_id", "size", "source_size", "target", "size * copies AS taken", "copies", "get(positions, 0) AS first_position")
        assert same(mixing.mixed_documents(docs), plan)
    whole = mixing._copies
    monkeypatch.setattr(mixing, "_copies", lambda *given: whole(*given).filter("__at < 0.5"))
    half = mixing.mixed_documents(mixed).collect()
    early = {r["doc_id"]: sum(x < 0.5 for x in r["positions"]) for r in mixing.curriculum(mixed).collect()}
    assert {r["doc_id"]: r["copies"] for r in half} == early and all(r["taken"] == r["size"] * r["copies"] for r in half)


def test_texts_are_moved_to_their_part_and_to_their_range_only(spark, mixed):
    offsets = mixing.materialize(mixing._offsets(mixed.select("doc_id", "source", "text"), mixing.WEIGHTS, 1.5, 2), "offsets")
    plan = mixing._copies(mixed, offsets)._jdf.queryExecution().executedPlan().toString()
    with_text = [x for x in plan.splitlines() if "Exchange " in x and "__offset" not in x]
    assert sum("rangepartitioning" in x for x in with_text) == 1 and sum("hashpartitioning" in x for x in with_text) <= 2
    assert plan.count("Exchange ") == 3, plan


def test_mixing_awkward_rows(spark):
    docs = documents(spark)
    got = mixing.curriculum(docs).collect()
    assert len(got) == 16 and sum(r["doc_id"] is None for r in got) == 2
    assert all(r["size"] == 0 for r in got if r["doc_id"] in (4, 5, 6))
    copies = mixing.mix(docs)
    assert copies.columns == docs.columns
    assert copies.count() == sum(r["copies"] for r in got)
    assert mixing.curriculum(documents(spark, [])).count() == 0 and mixing.mix(documents(spark, [])).count() == 0


def tightest(sizes, sources, clusters, capacity):
    """Best fit by looking at all bins; of equally tight ones, the one that became so first."""
    bins, out, clock = [], [], 0
    for size, s, c in zip(sizes, sources, clusters):
        fits = [b for b in bins if b["left"] >= size and (s is None or s not in b["s"]) and (c is None or c not in b["c"]) and b["left"]]
        b = min(fits, key=lambda x: (x["left"], x["at"]), default=None)
        if b is None:
            b = {"left": capacity, "s": set(), "c": set(), "n": len(bins)}
            bins.append(b)
        out.append((b["n"], capacity - b["left"]))
        clock += 1
        b["left"] -= size
        b["at"] = clock
        b["s"].add(s)
        b["c"].add(c)
    return out


@pytest.mark.parametrize("seed", range(12))
def test_best_fit_against_a_search_of_all_bins(seed):
    rng = random.Random(seed)
    n = 300
    sizes = sorted((rng.randint(1, 50) for _ in range(n)), reverse=True)
    sources = [rng.choice(["hot", "hot", "hot", None, *"abcdef"]) for _ in range(n)]
    clusters = [rng.choice([1, 2, 3, None, *range(10, 200)]) for _ in range(n)]
    bins, starts = packing.best_fit(sizes, sources, clusters, 50)
    assert list(zip(bins.tolist(), starts.tolist())) == tightest(sizes, sources, clusters, 50)


def check_packing(pieces, sizes, capacity):
    """All words are in one piece each, no bin is overfull, pieces do not overlap, and conflicts are apart."""
    covered, bins = {}, {}
    for p in pieces:
        covered.setdefault(p["doc_id"], []).append((p["first_word"], p["n_words"]))
        if p["bin"] is not None:
            bins.setdefault((p["shard"], p["bin"]), []).append(p)
    for doc, parts in covered.items():
        at = 0
        for first, n in sorted(parts):
            assert first == at
            at += n
        assert at == sizes[doc]
    for own in bins.values():
        at = 0
        for p in sorted(own, key=lambda p: p["start"]):
            assert p["start"] == at
            at += p["n_words"]
        assert at <= capacity
        known = [p["source"] for p in own if p["source"] is not None]
        assert len(set(known)) == len(known) and len({p["cluster"] for p in own}) == len(own)
    return bins


def test_pack_documents(spark):
    rng = random.Random(4)
    texts = [" ".join(words(i % 350, rng.randrange(0, 90) if i < 350 else 30)) for i in range(400)] + [" ".join(words(1, 1000))]
    docs = many(spark, texts, lambda i: "hot" if i % 3 == 0 else f"s{i % 9}")
    pieces = packing.pack(docs, capacity=100, shard_rows=150).collect()
    check_packing(pieces, {i: len(t.split()) for i, t in enumerate(texts)}, 100)
    assert len({p["shard"] for p in pieces}) > 1
    assert sorted(p["n_words"] for p in pieces if p["doc_id"] == 400) == [100] * 10


def test_packing_awkward_rows(spark):
    docs = documents(spark).filter("doc_id is not null and doc_id <> 11")
    pieces = packing.pack(docs, capacity=64).collect()
    sizes = {r["doc_id"]: len((r["text"] or "").encode().split()) for r in docs.collect()}
    check_packing(pieces, sizes, 64)
    assert [(p["bin"], p["n_words"]) for p in pieces if p["doc_id"] in (4, 5, 6)] == [(None, 0)] * 3
    twice = packing.pack(documents(spark), capacity=1024).filter("doc_id = 11").collect()
    assert len(twice) == 2 and twice[0]["bin"] != twice[1]["bin"]
    assert packing.pack(documents(spark, [])).count() == 0


def test_a_repeated_row_is_dealt_over_shards(spark):
    row = (1, "one two three", "en", "a", 13, 0.5, "k", "c")
    docs = documents(spark, [row] * 3000 + [(i, f"t{i}", "en", "b", 3, 0.5, "k", "c") for i in range(2, 202)])
    pieces = packing.pack(docs, shard_rows=200).collect()
    per_shard = {}
    for p in pieces:
        per_shard[p["shard"]] = per_shard.get(p["shard"], 0) + 1
    assert len(pieces) == 3200 and max(per_shard.values()) < 800
    assert len({(p["shard"], p["bin"]) for p in pieces if p["doc_id"] == 1}) == 3000
