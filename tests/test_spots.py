"""Repetition profile against brute force, with one point that holds a third of the rows."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest

from roamgrid.operators import spots
from roamgrid.operators.quantiles import exact_quantiles

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def sample():
    rng = random.Random(11)
    rows = []
    for i in range(3000):
        lng, lat = (1.5, 2.5) if i % 3 == 0 else (rng.randrange(60) / 1000, rng.randrange(3) / 1000)
        seconds = rng.choice([0, 600, 86_399, 86_400]) + 86_400 * rng.randrange(9) if i % 2 else rng.randrange(20 * 86_400)
        rows.append((1 + rng.randrange(4), rng.choice("xyz"), f"f{i % 2}", i, START + timedelta(seconds=seconds), lng, lat))
    return rows


@pytest.fixture(scope="module")
def df(spark, sample):
    return spark.createDataFrame(
        sample, "species_id int, source string, file string, line long, appeared_utc timestamp, lng double, lat double")


def brute(sample, keep=lambda line: True):
    first = {}
    for r in sorted(sample, key=lambda r: (r[2], r[3])):
        first.setdefault((r[0], r[5], r[6], r[4]), r)
    rows = [r for r in first.values() if keep(r[3])]
    points = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r[4], r[2], r[3])):
        points[r[5], r[6]].append(r)
    pairs = [((b[4] - a[4]).total_seconds(), a[0] == b[0], a[1] == b[1], a[0] == 2, b[0] == 2)
             for p in points.values() for a, b in zip(p, p[1:])]
    return rows, points, pairs


def test_points(df, sample):
    rows, points, _ = brute(sample)
    got = spots.point_summary(spots.spot_rows(df)).first()
    sizes = [len(p) for p in points.values()]
    assert (got["sightings"], got["distinct_points"], got["max_at_point"]) == (len(rows), len(points), max(sizes))
    again = [p for p in points.values() if len(p) >= 2]
    assert got["mean_distinct_species"] == pytest.approx(np.mean([len({r[0] for r in p}) for p in again]))
    assert got["pct_in_repeated_points"] == pytest.approx(100 * sum(map(len, again)) / len(rows))
    bands = {b["band"]: b["points"] for b in got["histogram"]}
    assert bands["1"] == sizes.count(1) and bands["3-5"] == sum(3 <= n <= 5 for n in sizes)
    assert sum(bands.values()) == len(points) and list(bands) == ["1", "2", "3-5", "6-10", "11-50", ">50"]


def test_pairs_across_days(df, sample):
    _, _, pairs = brute(sample)
    got = Counter((r["gap_s"], r["same_species"], r["same_source"]) for r in spots.pairs(spots.spot_rows(df)).collect())
    assert got == Counter((g, s, o) for g, s, o, _, _ in pairs)


def test_pair_stats(df, sample):
    _, _, pairs = brute(sample)
    gaps = np.array([p[0] for p in pairs]) / 3600
    got = spots.pair_stats(spots.spot_rows(df)).first()
    assert got["pairs"] == len(pairs)
    assert got["same_species_rate"] == pytest.approx(np.mean([p[1] for p in pairs]))
    assert got["pct_gap_15min"] == pytest.approx(100 * np.mean(gaps <= 0.25))
    for p in spots.GAP_PROBS:
        assert got[f"gap_h_p{round(p * 100)}"] == pytest.approx(np.quantile(gaps, p))


def test_views(spark, df, sample):
    catalog = spark.createDataFrame([(2, "b", ["water"]), (3, "c", ["fire"])],
                                    "species_id int, name string, types array<string>")
    got = {r["view"]: r for r in spots.compare_views(df, catalog, "water", prefix=900, stride=7).collect()}
    keeps = {"complete": lambda n: True, "prefix": lambda n: n < 900, "stride": lambda n: n % 7 == 0}
    assert set(got) == set(keeps)
    for view, keep in keeps.items():
        rows, points, pairs = brute(sample, keep)
        r = got[view]
        assert (r["sightings"], r["distinct_points"], r["pairs"]) == (len(rows), len(points), len(pairs))
        assert r["share"] == pytest.approx(np.mean([x[0] == 2 for x in rows]))
        assert r["next_given_type"] == pytest.approx(np.mean([p[4] for p in pairs if p[3]]))
        assert r["next_given_other"] == pytest.approx(np.mean([p[4] for p in pairs if not p[3]]))
        assert r["near_dups"] == sum(p[1] and p[0] <= 900 for p in pairs)
        assert r["gap_h_p50"] == pytest.approx(np.quantile([p[0] / 3600 for p in pairs], 0.5))
        shares = np.array(list(Counter(x[0] for x in rows).values())) / len(rows)
        assert r["same_species_by_chance"] == pytest.approx((shares ** 2).sum())
        assert r["distinct_days"] == len({x[4].date() for x in rows})
        assert r["pct_dow0"] == pytest.approx(100 * np.mean([x[4].weekday() == 0 for x in rows]))


def test_without_pairs_there_are_no_pair_metrics(spark):
    df = spark.createDataFrame([(1, "x", "f", 0, START, 1.0, 1.0)], "species_id int, source string, file string, "
                               "line long, appeared_utc timestamp, lng double, lat double")
    rows = spots.spot_rows(df)
    assert spots.pair_stats(rows).count() == 0 and spots.same_source(rows).count() == 0
    assert spots.point_stats(rows).first()["pct_points_seen_once"] == 100.0


@pytest.mark.parametrize("width", [1, 7, 3600])
def test_quantiles(spark, width):
    rng = random.Random(width)
    data = [(g, rng.randrange(10 ** (g + 1))) for g in range(4) for _ in range(1 + 97 * g)]
    df = spark.createDataFrame([(g, v, 1) for g, v in data], "g int, v long, n long")
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = {(r["g"], r["p"]): r["v"] for r in exact_quantiles(df, "v", "n", probs, ["g"], width).collect()}
    for g in range(4):
        for p in probs:
            assert got[g, p] == pytest.approx(np.quantile([v for h, v in data if h == g], p))
