"""Spatial queries: a small known set, then bulk joins against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from roamgrid.operators import grid, listings, spatial
from roamgrid.schemas import EARTH_RADIUS_M
from roamgrid.sources import catalog as cat
from roamgrid.sources import store

# A row of places going north in steps of a thousandth of a degree (about 111 m), and one far away.
HERE = {"lng": 30.5, "lat": -10.0}
BOX = [[(30.4, -10.1), (30.6, -10.1), (30.6, -9.9975), (30.4, -9.9975), (30.4, -10.1)]]


@pytest.fixture(scope="module")
def four(spark):
    rows = [(f"s{i + 1}", 16 if i < 2 else 19, 30.5, -10.0 + i / 1000) for i in range(3)] + [("s4", 19, -120.0, 60.0)]
    return spark.createDataFrame(rows, "id string, species_id int, lng double, lat double")


@pytest.fixture(scope="module")
def two(spark):
    return spark.createDataFrame([(16, "heron", ["plain", "winged"]), (19, "otter", ["plain"])],
                                 "species_id int, name string, types array<string>")


def ids(df):
    return [r["id"] for r in df.collect()]


def test_near(four):
    assert ids(spatial.near(four, radius_m=500, **HERE)) == ["s1", "s2", "s3"]
    assert ids(spatial.near(four, radius_m=150, **HERE)) == ["s1", "s2"]
    assert ids(spatial.near(four, radius_m=500, species=16, **HERE)) == ["s1", "s2"]
    assert ids(spatial.near(four, radius_m=500, limit=1, **HERE)) == ["s1"]
    assert [r["distance_m"] for r in spatial.geonear(four, radius_m=500, **HERE).collect()] == [
        round(math.radians(i / 1000) * EARTH_RADIUS_M, 1) for i in range(3)]


def test_type_filters(four, two):
    assert cat.species_ids(two, type_name="winged") == [16]
    assert cat.species_ids(two, type_name=" Plain ") == [16, 19]
    assert cat.species_ids(two, 19, "plain") == [19]
    assert cat.species_ids(two, 19, "winged") == []
    assert cat.species_ids(two) is None
    assert ids(spatial.near(four, radius_m=500, species=[], **HERE)) == []
    assert cat.species_filter(four, two, 19, "winged").count() == 0
    with pytest.raises(ValueError):
        cat.species_ids(two, type_name="laser")
    for blank in ("", "  ", None):
        assert cat.species_ids(two, 19, blank) == [19] and cat.species_ids(two, None, blank) is None
    for wrong in (0, 152, True, "19", 19.0):
        with pytest.raises(ValueError):
            cat.species_ids(two, wrong)


def test_within(four):
    assert ids(spatial.within(four, BOX)) == ["s1", "s2", "s3"]
    assert ids(spatial.within(four, BOX, species=19)) == ["s3"]
    assert spatial.within_truncated(four, BOX, limit=2).first().asDict() == {"count": 2, "truncated": True}
    assert spatial.within_truncated(four, BOX, limit=3).first().asDict() == {"count": 3, "truncated": False}
    assert spatial.within_total(four, BOX).first()["total"] == 3
    assert [tuple(r) for r in spatial.within_top_species(four, BOX).collect()] == [(16, 2), (19, 1)]


@pytest.mark.parametrize("bad", [
    {"lat": 91}, {"lat": -91}, {"lng": 181}, {"lat": math.nan}, {"lat": math.inf}, {"lng": "x"}, {"lng": None},
    {"radius_m": 0}, {"radius_m": -5}, {"radius_m": 50001}, {"species": 0}, {"species": 152}, {"species": "x"},
    {"limit": 0}, {"limit": -1}, {"limit": 5000}, {"limit": 1.5}])
def test_bad_arguments(four, bad):
    with pytest.raises(ValueError):
        spatial.near(four, **{**HERE, "radius_m": 500, **bad})


@pytest.mark.parametrize("rings", [
    None, [], [[]], [[(0, 0), (1, 0), (0, 0)]], [[(0, 0), (1, 0), (1, 1), (0, 1)]], [[(0, 0), (200, 0), (1, 1), (0, 0)]],
    [[(0, 0), (1, 95), (1, 1), (0, 0)]], [[(0, 0), ("1", 0), (1, 1), (0, 0)]], [[(0, 0), (1, 0, 5), (1, 1), (0, 0)]],
    [[(i / 1000, i % 2) for i in range(501)] + [(0, 0)]], [[(10, 20), (-170, -20), (50, 50), (10, 20)]],
    [[(30.4, -10.1), (30.6, -9.9), (30.6, -10.1), (30.4, -9.9), (30.4, -10.1)]], [[(0, 0), (math.nan, 0), (1, 1), (0, 0)]], {1}])
def test_bad_polygons(four, rings):
    with pytest.raises(ValueError):
        spatial.within(four, rings)


def test_edges_are_great_circles(spark):
    rows = spark.createDataFrame([("on", 1, 0.0, 52.0), ("above", 1, 0.0, 54.0), ("below", 1, 0.0, 49.0)],
                                 "id string, species_id int, lng double, lat double")
    wide = [[(-30.0, 40.0), (30.0, 40.0), (30.0, 50.0), (-30.0, 50.0), (-30.0, 40.0)]]
    assert ids(spatial.within(rows, wide)) == ["below", "on"]


def test_polygon_over_the_date_line(spark):
    rows = spark.createDataFrame([("w", 1, 179.5, 1.0), ("e", 1, -179.5, 1.0), ("out", 1, 0.0, 1.0)],
                                 "id string, species_id int, lng double, lat double")
    ring = [[(179.0, 0.0), (-179.0, 0.0), (-179.0, 2.0), (179.0, 2.0), (179.0, 0.0)]]
    assert ids(spatial.within(rows, ring)) == ["e", "w"]
    polygons = spark.createDataFrame([(1, [[{"lng": x, "lat": y} for x, y in ring[0]]])],
                                     "polygon_id int, rings array<array<struct<lng:double,lat:double>>>")
    assert sorted(ids(spatial.polygon_pairs(rows, polygons))) == ["e", "w"]


# ---- bulk -----------------------------------------------------------------------------------------------------------

def meters(lng1, lat1, lng2, lat2):
    a, b, dl = math.radians(lat1), math.radians(lat2), math.radians(lng2 - lng1)
    h = math.sin((b - a) / 2) ** 2 + math.cos(a) * math.cos(b) * math.sin(dl / 2) ** 2
    return 2 * EARTH_RADIUS_M * math.asin(min(1.0, math.sqrt(h)))


@pytest.fixture(scope="module")
def skewed():
    """Points over the globe; a third of them at one spot, others near the poles and the date line."""
    rng = random.Random(7)
    spots = [(2.3522, 48.8566)] * 1000
    spots += [(rng.uniform(2.0, 2.7), rng.uniform(48.6, 49.1)) for _ in range(1200)]
    spots += [(rng.choice([-1, 1]) * rng.uniform(179.6, 180), rng.uniform(-0.3, 0.3)) for _ in range(300)]
    spots += [(rng.uniform(-180, 180), rng.choice([-1, 1]) * rng.uniform(89.6, 90)) for _ in range(300)]
    spots += [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(200)]
    return [(f"p{i:05}", 1 + i % 5, x, y) for i, (x, y) in enumerate(spots)]


QUERIES = [(0, 2.3522, 48.8566, 500.0, 1000, None), (1, 2.3, 48.9, 9000.0, 70, None), (2, 2.4, 48.8, 50000.0, 1000, [2, 3]),
           (3, 180.0, 0.0, 20000.0, 500, None), (4, -179.99, 0.1, 1500.0, 500, None), (5, 10.0, 89.9, 50000.0, 1000, None),
           (6, -100.0, -89.99, 3000.0, 1000, None), (7, 2.3522, 48.8566, 50000.0, 5, []), (8, 2.35, 48.85, 1800.0, 3, None)]


@pytest.mark.parametrize("max_bytes, crowd_rows", [(spatial.BROADCAST_BYTES, spatial.CROWD_ROWS), (0, 100)])
def test_near_join(spark, skewed, max_bytes, crowd_rows):
    rows = spark.createDataFrame(skewed, "id string, species_id int, lng double, lat double")
    queries = spark.createDataFrame(QUERIES, "query_id int, q_lng double, q_lat double, radius_m double, limit int, "
                                             "species_ids array<int>")
    joined = spatial.near_join(rows, queries, max_bytes, crowd_rows)
    assert "NestedLoop" not in joined._jdf.queryExecution().executedPlan().toString()
    got = {}
    for r in joined.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["id"])
    for q, lng, lat, radius, limit, species in QUERIES:
        away = sorted((meters(lng, lat, x, y), i) for i, s, x, y in skewed if species is None or s in species)
        assert got.get(q, []) == [i for d, i in away if d <= radius][:limit], q


def test_covers_are_small_and_hold_few_edges(spark):
    """A polygon 170 degrees wide with 500 vertices: few cells, no edges in the inner ones, and right answers."""
    n = 249
    top = [(-85 + 170 * i / n, 60 + 10 * math.sin(i)) for i in range(n + 1)]
    ring = top + [(x, -y) for x, y in reversed(top)]
    ring = [*ring, ring[0]][:501]
    ring[-1] = ring[0]
    table = spark.createDataFrame([(1, [[{"lng": x, "lat": y} for x, y in ring]])],
                                  "polygon_id int, rings array<array<struct<lng:double,lat:double>>>")
    prepared = spatial.G.prepare_polygons(table)
    cells = spatial.G.cover_cells(spatial.G.with_box_range(prepared))
    whole, touched = spatial.G.cell_edges(F.col("edges"), F.col("origin"))
    rows = cells.select(whole.alias("whole"), F.size(touched).alias("edges")).collect()
    assert len(rows) < 10_000 and sum(r["whole"] and not r["edges"] for r in rows) > 300
    assert sum(r["edges"] for r in rows) < 20 * len(ring)
    rng = random.Random(5)
    points = [(f"q{i:04}", 1, rng.uniform(-95, 95), rng.uniform(-80, 80)) for i in range(1500)]
    df = spark.createDataFrame(points, "id string, species_id int, lng double, lat double")
    got = sorted(r["id"] for r in spatial.polygon_pairs(df, table).select("id").collect())
    assert got == [i for i, _, x, y in points if inside([ring], x, y)]


def test_high_limits_are_honoured(spark):
    rows = spark.range(3000).select(F.format_string("p%05d", "id").alias("id"), F.lit(1).alias("species_id"), F.lit(5.0).alias("lng"),
                                    (F.col("id") / 1e6).alias("lat"))
    queries = spark.createDataFrame([(1, 5.0, 0.0, 5000.0, 2500), (2, 5.0, 0.0, 5000.0, 10)],
                                    "query_id int, q_lng double, q_lat double, radius_m double, limit int")
    for sizes in ((spatial.BROADCAST_BYTES, spatial.CROWD_ROWS), (0, 100)):
        counts = {r["query_id"]: r["count"] for r in spatial.near_join(rows, queries, *sizes).groupBy("query_id").count().collect()}
        assert counts == {1: 2500, 2: 10}


def unit(p):
    lng, lat = math.radians(p[0]), math.radians(p[1])
    return math.cos(lat) * math.cos(lng), math.cos(lat) * math.sin(lng), math.sin(lat)


def volume(a, b, c):
    return ((a[1] * b[2] - a[2] * b[1]) * c[0] + (a[2] * b[0] - a[0] * b[2]) * c[1] + (a[0] * b[1] - a[1] * b[0]) * c[2])


def arcs_cross(a, b, c, d):
    signs = {-volume(a, b, c) > 0, volume(a, b, d) > 0, -volume(c, d, b) > 0, volume(c, d, a) > 0}
    return len(signs) == 1


def cap(lng, lat, radius, n):
    """A ring of places at one distance from a centre, counter-clockwise."""
    c, r = unit((lng, lat)), math.radians(radius)
    e = (-math.sin(math.radians(lng)), math.cos(math.radians(lng)), 0.0)
    north = (c[1] * e[2] - c[2] * e[1], c[2] * e[0] - c[0] * e[2], c[0] * e[1] - c[1] * e[0])
    ring = []
    for i in range(n):
        t = 2 * math.pi * i / n
        x, y, z = (math.cos(r) * c[k] + math.sin(r) * (math.cos(t) * e[k] + math.sin(t) * north[k]) for k in range(3))
        ring.append((math.degrees(math.atan2(y, x)), math.degrees(math.asin(z))))
    return ring + ring[:1]


# Rings with a place inside.
AROUND = [(x, 75.0) for x in range(-170, 171, 20)] + [(x, -75.0) for x in range(170, -171, -20)]
WIDE = [
    ([[(-100.0, 0.0), (0.0, -1.0), (100.0, 0.0), (0.0, 50.0), (-100.0, 0.0)]], (3.3, 20.1)),
    ([cap(12.3, 90, 30, 7)], (31.7, 88.1)), ([cap(12.3, -90, 50, 9)[::-1]], (31.7, -88.1)),
    ([cap(-150, 30, 80, 12)], (-149.3, 31.1)), ([cap(77.7, -41, 88, 20)[::-1]], (77.1, -40.3)),
    ([cap(20, 80, 40, 12), cap(20, 85, 9, 8)], (20.3, 61.7)), ([cap(0.5, 90, 45, 8), cap(3.5, 90, 15, 8)[::-1]], (40.3, 62.3)),
    ([AROUND + AROUND[:1]], (179.3, 1.7)), ([cap(171, 3, 70, 30)], (171.3, 3.7)), ([cap(0.1, 90, 30, 5), cap(140, 80, 3, 5)], (-40.3, 70.7)),
]


def wide_inside(rings, known, p):
    """Whether an even number of edges lies on the arc to a place that is known to be inside."""
    p, q = unit(p), unit(known)
    return sum(arcs_cross(p, q, unit(a), unit(b)) for ring in rings for a, b in zip(ring, ring[1:])) % 2 == 0


@pytest.mark.parametrize("max_bytes", [spatial.BROADCAST_BYTES, 0])
def test_wide_polygons(spark, max_bytes):
    """Half globes, caps around either pole, holes and a ring that leaves a strip out, against crossings in space."""
    rng = random.Random(11)
    places = [(rng.uniform(-180, 180), math.degrees(math.asin(rng.uniform(-1, 1)))) for _ in range(3000)]
    places += [(rng.uniform(-180, 180), rng.choice([-1, 1]) * rng.uniform(80, 89.99)) for _ in range(500)]
    places += [(rng.choice([-1, 1]) * rng.uniform(179, 180), rng.uniform(-90, 90)) for _ in range(500)]
    df = spark.createDataFrame([(f"w{i:04}", 1, x, y) for i, (x, y) in enumerate(places)], "id string, species_id int, lng double, lat double")
    table = spark.createDataFrame([(k, [[{"lng": float(x), "lat": float(y)} for x, y in r] for r in rings]) for k, (rings, _) in enumerate(WIDE)],
                                  "polygon_id int, rings array<array<struct<lng:double,lat:double>>>")
    got = {}
    for r in spatial.polygon_pairs(df, table, max_bytes).select("polygon_id", "id").collect():
        got.setdefault(r["polygon_id"], []).append(r["id"])
    for k, (rings, known) in enumerate(WIDE):
        wanted = [f"w{i:04}" for i, p in enumerate(places) if wide_inside(rings, known, p)]
        assert 0 < len(wanted) < len(places) and sorted(got[k]) == wanted, k
    if max_bytes:
        totals = {r["polygon_id"]: r["count"] for r in spatial.within_totals(df, table).collect()}
        assert totals == {k: len(v) for k, v in got.items()}
        assert ids(spatial.within(df, WIDE[3][0], limit=1000)) == sorted(got[3])[:1000]
        assert spatial.within_total(df, WIDE[1][0]).first()["total"] == len(got[1])


def test_half_globes_lie_left_of_their_ring(spark):
    df = spark.createDataFrame([("n", 1, 10.0, 5.0), ("s", 1, 10.0, -5.0), ("pole", 1, 0.0, 90.0)], "id string, species_id int, lng double, lat double")
    ring = [(x, 0.0) for x in (-180, -90, 0, 90, -180)]
    assert ids(spatial.within(df, [ring])) == ["n", "pole"] and ids(spatial.within(df, [ring[::-1]])) == ["s"]


def shapes():
    rng = random.Random(3)
    for k in range(30):
        x, y, n = rng.uniform(2.1, 2.6), rng.uniform(48.7, 49.0), rng.randint(3, 9)
        angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
        ring = [(x + 0.1 * rng.uniform(0.3, 1) * math.cos(a), y + 0.1 * rng.uniform(0.3, 1) * math.sin(a)) for a in angles]
        yield k, [ring + ring[:1]]
    yield 30, [[(2.0, 48.6), (2.7, 48.6), (2.7, 49.1), (2.0, 49.1), (2.0, 48.6)],
               [(2.3, 48.8), (2.4, 48.8), (2.4, 48.9), (2.3, 48.9), (2.3, 48.8)]]


def inside(rings, lng, lat):
    odd = False
    for ring in rings:
        for (xa, ya), (xb, yb) in zip(ring, ring[1:]):
            if (xa <= lng < xb) or (xb <= lng < xa):
                a, b, t = math.radians(xa), math.radians(xb), math.radians(lng)
                edge = (math.tan(math.radians(ya)) * math.sin(b - t) + math.tan(math.radians(yb)) * math.sin(t - a)) / math.sin(b - a)
                odd ^= math.tan(math.radians(lat)) < edge
    return odd


def test_crowds_are_thinned_to_what_can_be_returned(spark, skewed):
    rows = spark.createDataFrame(skewed, "id string, species_id int, lng double, lat double")
    thin = spatial.thin_crowds(rows, 7, ["species_id"], 100)
    crowd = [r["id"] for r in thin.filter("lng = 2.3522 and lat = 48.8566").orderBy("id").collect()]
    assert crowd == [f"p{i:05}" for i in range(35)]
    assert thin.count() == len(skewed) - 1000 + 35
    plan = thin._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 3
    assert spatial.thin_crowds(rows, 7, ["species_id"]) is rows


@pytest.mark.parametrize("max_bytes, crowd_rows", [(spatial.BROADCAST_BYTES, spatial.CROWD_ROWS), (0, 100)])
def test_within_join(spark, skewed, max_bytes, crowd_rows):
    rows = spark.createDataFrame(skewed, "id string, species_id int, lng double, lat double")
    table = [(k, [[{"lng": x, "lat": y} for x, y in r] for r in rings]) for k, rings in shapes()]
    polygons = spark.createDataFrame(table, "polygon_id int, rings array<array<struct<lng:double,lat:double>>>")
    wanted = {k: [i for i, _, x, y in skewed if inside(rings, x, y)] for k, rings in shapes()}
    totals = {r["polygon_id"]: r["count"] for r in spatial.within_totals(rows, polygons, max_bytes).collect()}
    assert totals == {k: len(v) for k, v in wanted.items()}
    firsts = {}
    for r in spatial.within_join(rows, polygons, 20, max_bytes, crowd_rows).orderBy("polygon_id", "rank").collect():
        firsts.setdefault(r["polygon_id"], []).append(r["id"])
    assert firsts == {k: sorted(v)[:20] for k, v in wanted.items() if v}


@pytest.mark.parametrize("leaf_places", [1, 5, 1000])
def test_polygons_are_cut_to_their_rim(spark, skewed, leaf_places):
    """Cells of every size, edges along meridians and cells inside as a whole give the counts of plain tests."""
    rows = spark.createDataFrame(skewed, "id string, species_id int, lng double, lat double")
    box = [[(2.2, 48.7), (2.4, 48.7), (2.4, 48.9), (2.2, 48.9), (2.2, 48.7)], [(2.3, 48.8), (2.36, 48.8), (2.36, 48.87), (2.3, 48.87), (2.3, 48.8)]]
    arrow = [[(2.1, 48.7), (2.6, 48.7), (2.35, 48.85), (2.6, 49.0), (2.1, 49.0), (2.1, 48.7)]]
    every = [*shapes(), (901, box), (902, arrow), (901, box)]
    table = [(k, [[{"lng": x, "lat": y} for x, y in r] for r in rings]) for k, rings in every]
    polygons = spark.createDataFrame(table, "polygon_id int, rings array<array<struct<lng:double,lat:double>>>")
    totals = {r["polygon_id"]: r["count"] for r in spatial.within_totals(rows, polygons, leaf_places=leaf_places).collect()}
    wanted = {k: sum(inside(rings, x, y) for _, _, x, y in skewed) for k, rings in every}
    assert totals == wanted | {901: 2 * wanted[901]}


def test_first_ids_are_found_in_ranges(spark, skewed):
    rows = spark.createDataFrame(skewed, "id string, species_id int, lng double, lat double")
    table = [(k, [[{"lng": x, "lat": y} for x, y in r] for r in rings]) for k, rings in shapes()]
    polygons = spark.createDataFrame(table, "polygon_id int, rings array<array<struct<lng:double,lat:double>>>")
    assert len(spatial._id_ranges(rows, 5)) > 1 and spatial._id_ranges(rows, spatial.FIRST_IDS) == []
    firsts = {}
    for r in spatial.within_join(rows, polygons, 20, first_ids=5).orderBy("polygon_id", "rank").collect():
        firsts.setdefault(r["polygon_id"], []).append(r["id"])
    wanted = {k: sorted(i for i, _, x, y in skewed if inside(rings, x, y))[:20] for k, rings in shapes()}
    assert firsts == {k: v for k, v in wanted.items() if v}


def test_wide_circles_shrink_to_their_own_cell(spark):
    rows = spark.range(4000).select(F.format_string("p%05d", "id").alias("id"), (F.col("id") % 2).cast("int").alias("species_id"),
                                    (5 + F.col("id") % 60 / 1e4).alias("lng"), (F.col("id") / 60 / 1e4).alias("lat"))
    queries = spark.createDataFrame([(0, 5.003, 0.003, 25000.0, 10, None), (1, 5.003, 0.003, 25000.0, 10, [1]), (2, 5.003, 0.003, 25000.0, 10, [7])],
                                    "_row long, q_lng double, q_lat double, radius_m double, limit int, species_ids array<int>")
    radii = {r["_row"]: r["radius_m"] for r in spatial.radius_of_own_cell(rows, queries).collect()}
    assert radii[0] < 250 and radii[1] < 250 and radii[2] == 25000.0


def test_large_covers_are_not_broadcast(spark, skewed):
    rows = spark.createDataFrame(skewed, "id string, species_id int, lng double, lat double")
    queries = spark.createDataFrame(QUERIES, "query_id int, q_lng double, q_lat double, radius_m double, limit int, species_ids array<int>")
    table = [(k, [[{"lng": x, "lat": y} for x, y in r] for r in rings]) for k, rings in shapes()]
    polygons = spark.createDataFrame(table, "polygon_id int, rings array<array<struct<lng:double,lat:double>>>")
    for df in (spatial.near_join(rows, queries, max_bytes=0), spatial.polygon_pairs(rows, polygons, max_bytes=0)):
        assert "SortMergeJoin" in df._jdf.queryExecution().executedPlan().toString()


# ---- tables ---------------------------------------------------------------------------------------------------------

def test_boxes_reach_the_scan(spark, skewed, tmp_path):
    rows = spark.createDataFrame(skewed, "id string, species_id int, lng double, lat double")
    path = str(tmp_path / "clustered")
    store.write_clustered(rows, path, parts=6)
    table = spark.read.parquet(path)
    assert table.count() == len(skewed)
    spark.conf.set("spark.sql.maxMetadataStringLength", 10000)
    plan = spatial.near(table, radius_m=500, species=16, **HERE)._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(lat" in pushed and "LessThanOrEqual(lat" in pushed and "EqualTo(species_id" in pushed
    assert "GreaterThanOrEqual(lng" in pushed
    hot = table.filter("lng = 2.3522 and lat = 48.8566").select(F.input_file_name()).distinct().count()
    assert hot > 1  # a crowded cell is spread over several files


def test_boxes_reach_the_scan_of_loaded_documents(spark, skewed, tmp_path):
    rows = spark.createDataFrame(skewed, "id string, species_id int, lng double, lat double").selectExpr(
        "id", "species_id", "'S' AS source", "lng", "lat", "TIMESTAMP'2024-01-01 00:00:00' AS appeared_utc",
        "TIMESTAMP'2024-01-01 00:00:00' AS appeared_local", "0 AS local_hour", "0 AS local_dow")
    clean, target = str(tmp_path / "clean"), str(tmp_path / "documents")
    store.write_clean(rows, clean)
    store.load_sightings(spark, clean, target)
    spark.conf.set("spark.sql.maxMetadataStringLength", 10000)
    found = spatial.near(store.from_documents(spark.read.parquet(target)), lng=2.3522, lat=48.8566, radius_m=500, species=3, limit=1000)
    plan = found._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert all(x in pushed for x in ("GreaterThanOrEqual(lat", "LessThanOrEqual(lat", "GreaterThanOrEqual(lng", "EqualTo(species_id"))
    assert found.count() == sum(s == 3 and meters(2.3522, 48.8566, x, y) <= 500 for _, s, x, y in skewed)


def test_hotspots_break_ties_as_listed(spark, two):
    rows = [(f"a{i}", s, 0.005, 0.005) for i, s in enumerate([16, 16, 19, 19])] + [("b", 16, 1.005, 0.005)]
    df = spark.createDataFrame(rows, "id string, species_id int, lng double, lat double")
    hot = grid.hotspots(df, two).orderBy("rank").collect()
    assert [(r["rank"], r["cell_id"], r["count"], r["species"], r["distinct_points"]) for r in hot] == [
        (1, "0_0", 4, 2, 1), (2, "100_0", 1, 1, 1)]
    assert [(s["count"], s["species_id"]) for s in hot[0]["top_species"]] == [(2, 19), (2, 16)]
    assert grid.recount_hotspots(df, grid.top_cells(grid.agg_grid(df))).filter("count <> recount").count() == 0
    assert [r["rank"] for r in listings.list_hotspots(grid.hotspots(df, two), 1).collect()] == [1]


def test_any_species_id_is_counted(spark):
    ids_ = [500, 500, -4, 191, 192, 0, 63, 64, 127, 128, 2**31 - 1, 5, 5]
    rows = [(f"a{i}", s, 0.005, 0.005) for i, s in enumerate(ids_)] + [("b", 7, 1.005, 0.005), ("c", 900, 2.005, 0.005)]
    df = spark.createDataFrame(rows, "id string, species_id int, lng double, lat double")
    assert {(r["cx"], r["size"], r["nunique"]) for r in grid.grid_bench(df).collect()} == {(0, 13, 11), (100, 1, 1), (200, 1, 1)}
    assert str(grid.grid_bench(df)._jdf.queryExecution().optimizedPlan()).count("Join") == 0
    assert {(r["cx"], r["species"]) for r in grid.agg_grid(df).collect()} == {(0, 11), (100, 1), (200, 1)}
