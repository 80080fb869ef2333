import math
import sys
import zlib
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from edges import F, by_id, documents, many  # noqa: E402
from roamgrid.llm import sharding  # noqa: E402


@pytest.mark.parametrize("pool,marked,draws", [(100, 10, 7), (1000, 400, 300), (5, 5, 3), (50, 0, 10), (50, 1, 49), (7, 3, 7), (9, 4, 0)])
def test_draws_invert_the_hypergeometric_law(spark, pool, marked, draws):
    us = [(i + 0.37) / 300 for i in range(300)]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in us], "u double").selectExpr(
        sharding.hypergeometric_sql(str(pool), str(marked), str(draws), "u")).collect()]
    ways = {k: math.comb(marked, k) * math.comb(pool - marked, draws - k) for k in range(max(0, draws + marked - pool), min(draws, marked) + 1)}
    total, want = sum(ways.values()), []
    for u in us:
        done = 0
        for k, w in ways.items():
            done += w
            if done >= u * total:
                want.append(k)
                break
    assert got == want


def drawn(spark, counts, shards, seed=3):
    table = spark.createDataFrame(list(enumerate(counts)), "part int, count long").filter("count > 0")
    rows = {r["part"]: r["rows"] for r in sharding.matrix(table, len(counts), shards, seed).collect()}
    assert sorted(rows) == list(range(len(counts)))
    return [rows[p] for p in range(len(counts))]


def test_matrix_has_the_given_margins(spark):
    for counts in ([5, 0, 17, 300], [0, 0], [1], [10_000, 3], [7, 0, 0, 1, 900, 12, 5, 0, 44]):
        rows = drawn(spark, counts, 7)
        assert [sum(r) for r in rows] == counts
        columns = [sum(r[s] for r in rows) for s in range(7)]
        assert sum(columns) == sum(counts) and max(columns) - min(columns) <= 1 and min(map(min, rows)) >= 0


def test_matrix_of_large_parts(spark):
    """256 parts of 2,000,000 rows: exact margins, and cells that spread as the law says."""
    rows = drawn(spark, [2_000_000] * 256, 24)
    assert all(sum(r) == 2_000_000 for r in rows) and {sum(r[s] for r in rows) for s in range(24)} <= {21_333_333, 21_333_334}
    mean, variance = 2_000_000 / 24, 2_000_000 / 24 * 23 / 24 * 255 / 256
    spread = sum((x - mean) ** 2 for r in rows for x in r) / (256 * 24) / variance
    assert 0.92 < spread < 1.08


def test_cells_follow_the_law(spark):
    """Over seeds, how many rows of the third of three parts go to the first shard: the shares of the hypergeometric law."""
    seeds, counts = 40, [3, 2, 4]
    seen = Counter(drawn(spark, counts, 3, seed)[2][0] for seed in range(seeds))
    mean = sum(k * n for k, n in seen.items()) / seeds
    assert max(seen) <= 3 and abs(mean - 4 / 3) < 0.4


def test_shards_are_a_permutation_of_exact_sizes(spark):
    docs = many(spark, [f"text {i % 40}" for i in range(500)])
    rows = sharding.shard_documents(docs).collect()
    sizes = Counter(r["shard"] for r in rows)
    assert set(sizes) == set(range(24)) and set(sizes.values()) == {20, 21}
    assert sorted(r["doc_id"] for r in rows) == list(range(500))
    for s in range(24):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))
    assert all(r["text_crc32"] == zlib.crc32(f"text {r['doc_id'] % 40}".encode()) and r["law"] == "rows" for r in rows)
    assert sorted(map(str, sharding.shard_documents(docs).collect())) == sorted(map(str, rows))


def test_places_are_uniform(spark):
    """Over seeds, documents visit both shards about equally often, and pairs are together about as often as by chance."""
    docs, seeds, n = spark.range(40).withColumnRenamed("id", "doc_id"), 10, 40
    seen, together = Counter(), 0
    for seed in range(seeds):
        at = {r["doc_id"]: r["shard"] for r in sharding.shuffle(docs, 2, seed).collect()}
        seen.update(i for i, s in at.items() if s == 0)
        together += sum(at[i] == at[i + 1] for i in range(0, n, 2))
    assert sum(seen.values()) == seeds * n // 2 and max(seen.values()) < seeds and len(seen) == n
    assert 70 <= together <= 125


def test_awkward_rows(spark):
    got = by_id(sharding.shard_documents(documents(spark)))
    assert sum(map(len, got.values())) == 16 and got[4][0]["size"] == got[5][0]["size"] == 8
    assert got[13][0]["size"] == 8 + len(by_id(documents(spark))[13][0]["text"].encode()) and got[4][0]["text_crc32"] == 0
    assert all(r["grown_shard"] is None for rs in got.values() for r in rs)
    assert sharding.shard_documents(documents(spark, [])).count() == 0


def test_whole_documents_are_moved(spark, monkeypatch):
    """Size and checksum are of the texts that arrive, and every column goes along."""
    docs, shuffle, moved = many(spark, [f"text {i}" for i in range(30)]), sharding.shuffle, []

    def spoiled(rows, *args, **options):
        moved.append(rows.schema["document"].dataType.names)
        return shuffle(rows, *args, **options).withColumn("document", F.col("document").withField("text", F.lit("spoiled")))

    monkeypatch.setattr(sharding, "shuffle", spoiled)
    rows = sharding.shard_documents(docs).collect()
    assert moved == [docs.columns] and len(rows) == 30
    assert all(r["size"] == 15 and r["text_crc32"] == zlib.crc32(b"spoiled") for r in rows)


def test_texts_cross_both_exchanges(spark):
    plan = sharding.shard_documents(many(spark, ["a b", "c"]))._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len([line for line in windows if "row_number" in line]) == 2
