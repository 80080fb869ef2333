"""Request tables: every bad request of the known lists is rejected for its reason."""

import itertools
import json
import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from roamgrid.operators import requests

# Made for these tests: what is right, and one parameter at a time made wrong.
GOOD = {"lat": "-10.0", "lng": "30.5", "radius": "750", "limit": None, "species": None, "type": None}
WRONG = {
    "lat": {"missing": [None, ""], "range": ["90.5", "-1e2"], "not_finite": ["NaN", "-Infinity", "1e999"], "not_numeric": ["north", "5f"]},
    "lng": {"missing": [None], "range": ["180.001", "-400"], "not_finite": ["inf"], "not_numeric": ["0x10", "1,5"]},
    "radius": {"missing": [""], "range": ["0", "-1", "50000.5", "1e6"], "not_finite": ["nan"], "not_numeric": ["5 km"]},
    "species": {"range": ["0", "-7", "152", "4000"], "not_integer": ["cat", "1.0"]},
    "limit": {"range": ["0", "-3", "1001", "2500", "9" * 20], "not_integer": ["2.5", "all"]},
    "type": {"unknown": ["laser"]},
}
POINTS = [({}, None), ({"limit": ""}, None), ({"limit": " 7 "}, None), ({"type": " Winged "}, None), ({"lat": "-1.0e1"}, None),
          ({"lat": "95", "lng": ""}, "lng:missing")]
POINTS += [({name: value}, f"{name}:{problem}") for name, kinds in WRONG.items() for problem, values in kinds.items() for value in values]


@pytest.fixture(scope="module")
def two(spark):
    return spark.createDataFrame([(16, "heron", ["plain", "winged"]), (19, "otter", ["plain"])],
                                 "species_id int, name string, types array<string>")


def check(spark, two, rows):
    schema = "query_id int, lat string, lng string, radius string, limit string, species string, type string"
    df = spark.createDataFrame([(i, *{**GOOD, **r}.values()) for i, r in enumerate(rows)], schema)
    return requests.check_point_requests(df, two).orderBy("query_id").collect()


def test_point_requests(spark, two):
    got = check(spark, two, [r for r, _ in POINTS])
    assert [(r["reason"], POINTS[r["query_id"]][0]) for r in got] == [(reason, row) for row, reason in POINTS]
    assert [got[i]["limit"] for i in (0, 1, 2)] == [50, 50, 7]
    assert got[5]["q_lng"] is None


def test_species_of_a_request(spark, two):
    rows = [{}, {"species": "19"}, {"type": "plain"}, {"type": "plain", "species": "19"}, {"type": "winged", "species": "19"}]
    assert [r["species_ids"] for r in check(spark, two, rows)] == [None, [19], [16, 19], [19], []]


SQUARE = [[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]


def polygon(*rings):
    return {"type": "Polygon", "coordinates": list(rings)}


POLYGONS = [
    (polygon(SQUARE), None), ({"type": "Feature", "geometry": polygon(SQUARE)}, None),
    (polygon(SQUARE, [[0.2, 0.2], [0.4, 0.2], [0.4, 0.4], [0.2, 0.2]]), None),
    (polygon([[0, 0], [4, 0], [2, 1], [4, 4], [0, 4], [0, 0]]), None),
    (None, "body:not_an_object"), ([], "body:not_an_object"), ({"type": "Point", "coordinates": [1, 2]}, "type:not_polygon"),
    ({"type": "Polygon"}, "rings:missing"), (polygon(), "rings:missing"), (polygon([]), "ring:size"),
    (polygon([[0, 0], [1, 0], [0, 0]]), "ring:size"), (polygon(SQUARE[:-1]), "ring:open"),
    (polygon([[0, 0], [200, 0], [1, 1], [0, 0]]), "position:range"), (polygon([[0, 0], [1, 95], [1, 1], [0, 0]]), "position:range"),
    (polygon([[0, 0], ["1", 0], [1, 1], [0, 0]]), "position:not_numeric"),
    (polygon([[0, 0], [True, 0], [1, 1], [0, 0]]), "position:not_numeric"),
    (polygon([[0, 0], [1, 0, 5], [1, 1], [0, 0]]), "position:shape"), (polygon([[0, 0], 5, [1, 1], [0, 0]]), "position:shape"),
    (polygon(SQUARE, [[0, 0], [1, 0]]), "ring:size"),
    (polygon([[i / 1000, i % 7] for i in range(500)] + [[0, 0]]), "vertices:too_many"),
    (polygon([[0, 0], [1, 1], [1, 0], [0, 1], [0, 0]]), "ring:self_intersection"),
    (polygon([[-100, 0], [0, -1], [100, 0], [0, 50], [-100, 0]]), None),
    (polygon([[0, 60], [90, 60], [180, 60], [-90, 60], [0, 60]]), None),
    (polygon([[0, 60], [180, 60], [90, 60], [-90, 60], [0, 60]]), "ring:self_intersection"),
    (polygon([[-170, 70], [100, 20], [170, 70], [100, 80], [-170, 70]]), None),
    (polygon([[10, 20], [-170, -20], [50, 50], [10, 20]]), "edge:antipodal"),
    (polygon([[170, 0], [-170, 0], [-170, 5], [170, 5], [170, 0]]), None),
]


def test_polygons(spark):
    df = spark.createDataFrame([(i, json.dumps(p)) for i, (p, _) in enumerate(POLYGONS)] + [(99, "{")],
                               "polygon_id int, body string")
    got = requests.reject_self_intersections(requests.check_polygons(df)).orderBy("polygon_id").collect()
    assert [r["reason"] for r in got] == [reason for _, reason in POLYGONS] + ["body:not_an_object"]
    assert [[p["lng"], p["lat"]] for p in got[1]["rings"][0]] == SQUARE
    assert got[4]["rings"] is None


def plane_crosses(rings):
    """Great circles are straight lines in the plane that touches the globe at the middle of the polygon: exact tests with fractions."""
    points = [p for ring in rings for p in ring]
    lng0, lat0 = (math.radians((min(c) + max(c)) / 2) for c in zip(*points))

    def flat(p):
        lng, lat = math.radians(p[0]) - lng0, math.radians(p[1])
        depth = math.sin(lat0) * math.sin(lat) + math.cos(lat0) * math.cos(lat) * math.cos(lng)
        return (Fraction(math.cos(lat) * math.sin(lng) / depth),
                Fraction((math.cos(lat0) * math.sin(lat) - math.sin(lat0) * math.cos(lat) * math.cos(lng)) / depth))

    def side(a, b, c):
        return (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])

    edges = [(flat(a), flat(b)) for ring in rings for a, b in zip(ring, ring[1:])]
    return any(side(*e, f[0]) * side(*e, f[1]) < 0 and side(*f, e[0]) * side(*f, e[1]) < 0 for e, f in itertools.combinations(edges, 2)
               if not {*e} & {*f})


def test_crossings_on_the_sphere(spark):
    rng, shapes = random.Random(7), []
    for n in range(150):
        x, y, size = rng.uniform(-170, 170), rng.uniform(-60, 60), rng.choice([0.01, 1, 25])
        rings = []
        for _ in range(rng.choice([1, 1, 2])):
            around = sorted(rng.uniform(0, 6.28) for _ in range(rng.randrange(3, 9)))
            if rng.random() < 0.3:
                rng.shuffle(around)
            ring = [[x + size * rng.uniform(0.2, 1) * math.cos(t), y + size * rng.uniform(0.2, 1) * math.sin(t)] for t in around]
            rings.append([*ring, ring[0]])
        shapes.append((rings, plane_crosses(rings)))
    assert 30 < sum(c for _, c in shapes) < 120
    box = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]
    shapes += [([box], False), ([box, [[1, 1], [2, 1], [2, 2], [1, 1]]], False), ([box, [[1, 1], [9, 1], [2, 2], [1, 1]]], True),
               ([[[0, 0], [4, 0], [4, 4], [6, 6], [4, 4], [0, 4], [0, 0]]], True),  # a spike
               ([[[0, 0], [4, 0], [2, 0], [2, 4], [0, 0]]], True),  # back along the equator, not as far
               ([[[1, 1]] * 4], True), ([[[0, 0], [4, 0], [0, 0], [4, 0], [0, 0]]], True), ([[[0, 0], [0, 0], [4, 0], [4, 4], [0, 0]]], False),
               ([[[0, 0], [2, 2], [4, 0], [4, 4], [2, 2], [0, 4], [0, 0]]], True),  # comes back to a place
               ([box, box], True), ([[[-40, 50], [40, 50], [41, 52], [0, 54], [-41, 52], [-40, 50]]], True),
               ([[[-40, 5], [40, 5], [41, 52], [0, 54], [-41, 52], [-40, 5]]], False),
               ([[[170, 0], [-170, 0], [-170, 5], [170, 5], [170, 0]]], False), ([[[170, 0], [-170, 5], [-170, 0], [170, 5], [170, 0]]], True),
               ([[[x, y] for x, y in ((math.cos(i / 499 * 6.2), math.sin(i / 499 * 6.2)) for i in range(499))] + [[1.0, 0.0]]], False)]
    rows = [(i, [[{"lng": float(x), "lat": float(y)} for x, y in ring] for ring in rings]) for i, (rings, _) in enumerate(shapes)]
    table = spark.createDataFrame(rows, "polygon_id int, rings array<array<struct<lng:double,lat:double>>>")
    got = {r["polygon_id"]: r["c"] for r in table.select("polygon_id", requests.self_intersects(F.col("rings")).alias("c")).collect()}
    assert [i for i, (_, c) in enumerate(shapes) if got[i] != c] == []
