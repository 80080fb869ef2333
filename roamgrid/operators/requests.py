"""Tables of requests split into accepted and rejected rows (Q1-Q3): the bulk form of argument checking.

``reason`` is NULL for an accepted row, else ``parameter:problem`` of the first check that fails.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roamgrid.functions.geodesy import relative_lng
from roamgrid.functions.once import compute_once
from roamgrid.schemas import DEFAULT_LIMIT, MAX_LIMIT, MAX_RADIUS_M, MAX_SPECIES, MAX_VERTICES, MIN_SPECIES

# Number formats that count as numeric, and the words for values that are no finite number.
FLOAT = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
NOT_FINITE = r"(?i)^\s*[+-]?(nan|inf|infinity)\s*$"
INTEGER = r"^\s*[+-]?\d+\s*$"


def _absent(text: Column) -> Column:
    return text.isNull() | (text == "")


def _number(text: Column) -> Column:
    return F.when(text.rlike(FLOAT), F.trim(text).try_cast("double"))


def _integer(text: Column) -> Column:
    return F.when(text.rlike(INTEGER), F.trim(text).try_cast("long"))


def _number_problem(name: str) -> list[tuple[Column, str]]:
    text = F.col(name)
    finite = _number(text).isNotNull() & (F.abs(_number(text)) < float("inf"))
    return [(_absent(text), f"{name}:missing"),
            (text.rlike(NOT_FINITE) | (text.rlike(FLOAT) & ~finite), f"{name}:not_finite"),
            (~text.rlike(FLOAT), f"{name}:not_numeric")]


def _integer_problem(name: str, low: int, high: int) -> list[tuple[Column, str]]:
    text = F.col(name)
    present = ~_absent(text)
    return [(present & ~text.rlike(INTEGER), f"{name}:not_integer"),
            (present & ~F.coalesce(_integer(text).between(low, high), F.lit(False)), f"{name}:range")]


def _first(problems: list[tuple[Column, str]]) -> Column:
    reason = None
    for failed, name in problems:
        failed = F.coalesce(failed, F.lit(False))
        reason = F.when(failed, name) if reason is None else reason.when(failed, name)
    return reason


def ids_by_type(catalog: DataFrame) -> DataFrame:
    """``type, type_ids``: at most 151 ids per type."""
    domain = catalog.filter(F.col("species_id").between(MIN_SPECIES, MAX_SPECIES))
    types = domain.select("species_id", F.explode("types").alias("type"))
    return types.groupBy("type").agg(F.sort_array(F.collect_set("species_id")).alias("type_ids"))


def check_point_requests(requests: DataFrame, catalog: DataFrame) -> DataFrame:
    """Check rows of text parameters ``query_id, lat, lng, radius, limit, species, type``.

    Accepted rows carry ``q_lng, q_lat, radius_m, limit, species_ids`` for the bulk search; ``species_ids`` is NULL
    without a species or type filter and may be empty when the two exclude each other.
    """
    wanted = F.when(_absent(F.col("type")), F.lit(None)).otherwise(F.lower(F.trim("type")))
    # The catalog has at most 151 species with a few types each.
    typed = requests.withColumn("_type", wanted).join(
        F.broadcast(ids_by_type(catalog).withColumnRenamed("type", "_type")), "_type", "left")
    lat, lng, radius = _number(F.col("lat")), _number(F.col("lng")), _number(F.col("radius"))
    problems = [
        *_number_problem("lat"), *_number_problem("lng"),
        (~lat.between(-90, 90), "lat:range"), (~lng.between(-180, 180), "lng:range"),
        *_number_problem("radius"), (~((radius > 0) & (radius <= MAX_RADIUS_M)), "radius:range"),
        *_integer_problem("species", MIN_SPECIES, MAX_SPECIES),
        (F.col("_type").isNotNull() & F.col("type_ids").isNull(), "type:unknown"),
        *_integer_problem("limit", 1, MAX_LIMIT),
    ]
    species = _integer(F.col("species")).cast("int")
    ids = F.when(F.col("_type").isNull(), F.when(species.isNotNull(), F.array(species))) \
        .when(species.isNull(), F.col("type_ids")) \
        .otherwise(F.filter("type_ids", lambda i: i == species))
    reason = _first(problems)
    checked = compute_once(typed, reason=reason)
    accepted = F.col("reason").isNull()
    values = {"q_lng": lng, "q_lat": lat, "radius_m": radius, "species_ids": ids,
              "limit": F.when(_absent(F.col("limit")), DEFAULT_LIMIT).otherwise(_integer(F.col("limit")).cast("int"))}
    return checked.select("query_id", *[F.when(accepted, c).alias(n) for n, c in values.items()], "reason")


# ---- polygons -------------------------------------------------------------------------------------------------------

def _items(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def _is_number(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.lit(False))


def _position_problem(position: Column) -> Column:
    pair = _items(position)
    x, y = pair[0], pair[1]

    def value(v: Column) -> Column:
        return F.try_variant_get(v, "$", "double")

    return (F.when(F.coalesce(F.size(pair), F.lit(-1)) != 2, "position:shape")
            .when(~(_is_number(x) & _is_number(y)), "position:not_numeric")
            .when(~(value(x).between(-180, 180) & value(y).between(-90, 90)), "position:range"))


def _first_of(array: Column) -> Column:
    return F.try_element_at(F.array_compact(array), F.lit(1))


def _ring_problem(ring: Column, points: Column) -> Column:
    positions = _items(ring)
    bad = _first_of(F.transform(positions, _position_problem))
    return (F.when(F.coalesce(F.size(positions), F.lit(-1)) < 4, "ring:size")
            .when(bad.isNotNull(), bad)
            .when(points[0] != F.element_at(points, -1), "ring:open"))


def _points(ring: Column) -> Column:
    def point(position: Column) -> Column:
        pair = _items(position)
        return F.struct(F.try_variant_get(F.get(pair, F.lit(0)), "$", "double").alias("lng"),
                        F.try_variant_get(F.get(pair, F.lit(1)), "$", "double").alias("lat"))

    return F.transform(_items(ring), point)


def _antipodal(rings: Column) -> Column:
    """Whether an edge joins opposite places of the globe, so that no great circle is the shortest."""
    def vector(p: Column) -> Column:
        return F.struct(F.radians(p["lng"]).alias("lng"), F.sin(F.radians(p["lat"])).alias("z"), F.cos(F.radians(p["lat"])).alias("r"))

    def opposite(a: Column, b: Column) -> Column:
        return a["r"] * b["r"] * F.cos(a["lng"] - b["lng"]) + a["z"] * b["z"] < -1 + 1e-14

    def found(ring: Column) -> Column:
        vectors, n = F.transform(ring, vector), F.size(ring) - 1
        return F.array_contains(F.zip_with(F.slice(vectors, 1, n), F.slice(vectors, 2, n), opposite), True)

    return F.exists(rings, found)


def check_polygons(requests: DataFrame) -> DataFrame:
    """Check GeoJSON text ``polygon_id, body``: a Polygon, or a Feature with one. Adds ``rings`` and ``reason``.

    JSON is read as a variant because the rules depend on the JSON type of every single value.
    """
    body = compute_once(requests, _v=F.try_parse_json("body"))
    is_object = F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False))
    feature = F.try_variant_get("_v", "$.type", "string").eqNullSafe("Feature")
    geometry = F.when(feature, F.try_variant_get("_v", "$.geometry", "variant")).otherwise(F.col("_v"))
    opened = compute_once(body, _object=is_object, _g=geometry)
    opened = compute_once(opened, _rings=F.try_variant_get("_g", "$.coordinates", "array<variant>"))
    shaped = compute_once(opened, rings=F.transform("_rings", _points))
    ring_problem = _first_of(F.zip_with("_rings", "rings", _ring_problem))
    vertices = F.aggregate("rings", F.lit(0), lambda n, ring: n + F.size(ring))
    reason = _first([
        (~F.col("_object"), "body:not_an_object"),
        (~F.try_variant_get("_g", "$.type", "string").eqNullSafe("Polygon"), "type:not_polygon"),
        (F.coalesce(F.size("_rings"), F.lit(-1)) < 1, "rings:missing"),
    ]).otherwise(F.coalesce(ring_problem, F.when(vertices > MAX_VERTICES, "vertices:too_many"),
                            F.when(_antipodal(F.col("rings")), "edge:antipodal")))
    checked = compute_once(shaped, reason=reason)
    return checked.select("polygon_id", F.when(F.col("reason").isNull(), F.col("rings")).alias("rings"), "reason")


# Volumes of three unit vectors below this are taken as zero: the points lie on one great circle.
_FLAT = 1e-15
# What rounding alone makes of such a volume.
_NOISE = 4e-16


def _vertex(point: Column, origin: Column) -> Column:
    """A position with its longitude from the origin and its unit vector."""
    lng, lat = F.radians(point["lng"]), F.radians(point["lat"])
    return F.struct(relative_lng(point["lng"], origin).alias("rel"), point["lat"].alias("lat"), (F.cos(lat) * F.cos(lng)).alias("x"),
                    (F.cos(lat) * F.sin(lng)).alias("y"), F.sin(lat).alias("z"))


def _volume(a: Column, b: Column, c: Column) -> Column:
    """The determinant of three unit vectors: positive if ``c`` lies left of the great circle from ``a`` to ``b``."""
    return ((a["y"] * b["z"] - a["z"] * b["y"]) * c["x"] + (a["z"] * b["x"] - a["x"] * b["z"]) * c["y"]
            + (a["x"] * b["y"] - a["y"] * b["x"]) * c["z"])


def _at_one_place(p: Column, q: Column) -> Column:
    return (p["rel"] == q["rel"]) & (p["lat"] == q["lat"])


def _cross(e: Column, f: Column) -> Column:
    """Whether two arcs without a common end meet inside: the ends of each lie on either side of the other, on one half of the globe."""
    a, b, c, d = e["a"], e["b"], f["a"], f["b"]
    volumes = -_volume(a, b, c), _volume(a, b, d), -_volume(c, d, b), _volume(c, d, a)
    return ((F.least(*volumes) > 0) | (F.greatest(*volumes) < 0)) & (F.greatest(*map(F.abs, volumes)) > _NOISE)


def _fold(at: Column, p: Column, q: Column) -> Column:
    """Whether the arcs from ``at`` to two points leave in one direction, so that one retraces the other."""
    def away(u: Column) -> list[Column]:
        return [u[c] - at[c] for c in "xyz"]

    def dot(u: list[Column], v: list[Column]) -> Column:
        return u[0] * v[0] + u[1] * v[1] + u[2] * v[2]

    up = [at[c] for c in "xyz"]
    # Both directions lie in the plane that touches the globe there.
    return (F.abs(_volume(p, at, q)) <= _FLAT) & (dot(away(p), away(q)) > dot(away(p), up) * dot(away(q), up))


def _clash(e: Column, f: Column) -> Column:
    """Whether two edges cross or run along each other. Arcs stay between the longitudes of their ends, which rules out most pairs."""
    aa, ab = _at_one_place(e["a"], f["a"]), _at_one_place(e["a"], f["b"])
    ba, bb = _at_one_place(e["b"], f["a"]), _at_one_place(e["b"], f["b"])
    folded = ((aa & _fold(e["a"], e["b"], f["b"])) | (ab & _fold(e["a"], e["b"], f["a"])) | (ba & _fold(e["b"], e["a"], f["b"]))
              | (bb & _fold(e["b"], e["a"], f["a"])))
    beside = (e["west"] <= f["east"]) & (f["west"] <= e["east"])
    return beside & F.when(aa | ab | ba | bb, folded).otherwise(_cross(e, f))


def _edges(ring: Column, origin: Column) -> Column:
    """The edges of a ring as arcs; a repeated position makes none. One that crosses the meridian opposite the origin takes all longitudes."""
    vertices = F.transform(ring, lambda p: _vertex(p, origin))
    n = F.size(ring) - 1

    def arc(a: Column, b: Column) -> Column:
        beyond = F.abs(a["rel"] - b["rel"]) >= 180
        return F.struct(a.alias("a"), b.alias("b"), F.when(beyond, F.lit(-180.0)).otherwise(F.least(a["rel"], b["rel"])).alias("west"),
                        F.when(beyond, F.lit(180.0)).otherwise(F.greatest(a["rel"], b["rel"])).alias("east"))

    arcs = F.zip_with(F.slice(vertices, 1, n), F.slice(vertices, 2, n), arc)
    return F.filter(arcs, lambda e: ~_at_one_place(e["a"], e["b"]))


def self_intersects(rings: Column) -> Column:
    """Whether edges of a polygon, as arcs of great circles, cross or retrace each other, within a ring or between rings; a ring of fewer
    than three places or with a place it comes back to counts as well.

    Works inside the row: a polygon has at most 500 vertices. Edges are taken from west to east, and each is compared with the later
    ones that start before it ends.
    """
    origin = rings[0][0]["lng"]
    by_ring = F.transform(rings, lambda ring: _edges(ring, origin))

    def thin(edges: Column) -> Column:
        places = F.transform(edges, lambda e: F.struct(e["a"]["rel"], e["a"]["lat"]))
        return (F.size(edges) < 3) | (F.size(F.array_distinct(places)) < F.size(edges))

    def later(edges: Column, e: Column, i: Column) -> Column:
        return F.exists(F.slice(edges, i + 2, F.size(edges)), lambda f: (f["west"] <= e["east"]) & _clash(e, f))

    ordered = F.array_sort(F.flatten(by_ring), lambda e, f: F.when(e["west"] < f["west"], -1).when(e["west"] > f["west"], 1).otherwise(0))
    found = F.transform(F.array(ordered), lambda edges: F.array_contains(F.transform(edges, lambda e, i: later(edges, e, i)), True))
    return F.exists(by_ring, thin) | F.element_at(found, 1)


def reject_self_intersections(checked: DataFrame) -> DataFrame:
    """Turn accepted polygons with a crossing or degenerate ring into rejected ones."""
    crossing = F.coalesce(self_intersects(F.col("rings")), F.lit(False))
    marked = compute_once(checked, reason=F.coalesce("reason", F.when(crossing, "ring:self_intersection")))
    return marked.withColumn("rings", F.when(F.col("reason").isNull(), F.col("rings")))
