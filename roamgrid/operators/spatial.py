"""Spatial queries: one at a time (J6, J7, J9, A30) and in bulk as joins."""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, replace
from functools import reduce
from numbers import Integral, Real

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roamgrid.functions import geodesy as G
from roamgrid.functions.once import compute_once
from roamgrid.operators.requests import check_polygons, reject_self_intersections
from roamgrid.schemas import DEFAULT_LIMIT, MAX_LIMIT, MAX_RADIUS_M, MAX_SPECIES, MIN_SPECIES
from roamgrid.session import materialize, spread

# Bytes the cover of a request table may take and still be broadcast.
BROADCAST_BYTES = 64 << 20
_NEAR_ROW_BYTES, _POLYGON_ROW_BYTES, _EDGE_BYTES = 200, 200, 80
# Edges up to which a single polygon becomes one plain expression.
_MAX_UNROLLED = 40
# A cell is hot when it holds more than this share of all sightings, so at most this many cells per level are.
_HOT_SHARES = 2000
# Rows of a small cell up to which its points are joined as they are.
CROWD_ROWS = 2000
_CROWD_GROUPS = 1000
# The key of requests for any species beside the species ids.
_ANY = -(1 << 40)
# Places in a cell up to which they are tested one by one; a cell with more is cut further.
LEAF_PLACES = 128
# Rows of the first range of ids that ``within_join`` looks at, and how many times larger each further range is.
FIRST_IDS, _WIDER = 10_000, 8
# Ids of which the ends of the ranges are taken; they decide how much is read at a time, not what is found.
_CUT_IDS = 100_000


# ---- argument checks ------------------------------------------------------------------------------------------------

def _within(name: str, value, low: float, high: float) -> float:
    """The value as a float when it is a real number from ``low`` to ``high``; NaN and infinities are not."""
    if isinstance(value, Real) and not isinstance(value, bool) and low <= value <= high:
        return float(value)
    raise ValueError(f"{name}: {value!r} is no number from {low} to {high}")


def _whole(name: str, value, low: int, high: int) -> int:
    if isinstance(value, Integral) and not isinstance(value, bool) and low <= value <= high:
        return int(value)
    raise ValueError(f"{name}: {value!r} is no integer from {low} to {high}")


def check_limit(limit, maximum: int = MAX_LIMIT) -> int:
    return _whole("limit", limit, 1, maximum)


def check_species(species_id) -> int:
    return _whole("species", species_id, MIN_SPECIES, MAX_SPECIES)


def checked_rings(spark: SparkSession, rings) -> list[list[tuple[float, float]]]:
    """Rings of (lng, lat) positions after the checks for polygon requests: one row goes through the same columns."""
    try:
        body = json.dumps({"type": "Polygon", "coordinates": rings})
    except TypeError as error:
        raise ValueError(f"no rings of positions: {error}") from None
    row = spark.range(1).select(F.col("id").alias("polygon_id"), F.lit(body).alias("body"))
    found = reject_self_intersections(check_polygons(row)).first()
    if found["reason"]:
        raise ValueError(found["reason"])
    return [[(p["lng"], p["lat"]) for p in ring] for ring in found["rings"]]


def _species_clause(species) -> Column | None:
    """None is no filter; an empty list matches nothing."""
    if species is None:
        return None
    if isinstance(species, (list, tuple, set)):
        return F.col("species_id").isin(sorted(species)) if species else F.lit(False)
    return F.col("species_id") == check_species(species)


def _filter_species(df: DataFrame, species) -> DataFrame:
    clause = _species_clause(species)
    return df if clause is None else df.filter(clause)


# ---- one query ------------------------------------------------------------------------------------------------------

def near(df: DataFrame, lng: float, lat: float, radius_m: float, species=None, limit: int = DEFAULT_LIMIT,
         raw_distance: bool = False) -> DataFrame:
    """Sightings within a radius, nearest first, ties by id. The box is constant and is pushed down to the scan."""
    lng, lat = _within("lng", lng, -180, 180), _within("lat", lat, -90, 90)
    radius_m = _within("radius", radius_m, math.ulp(0.0), MAX_RADIUS_M)
    limit = check_limit(limit)
    center = F.lit(lng), F.lit(lat)
    boxed = _filter_species(df, species).filter(
        G.in_box(F.col("lng"), F.col("lat"), G.circle_box(*center, F.lit(radius_m))))
    measured = boxed.withColumn("distance_m", G.distance_m(*center, F.col("lng"), F.col("lat")))
    nearest = measured.filter(F.col("distance_m") <= radius_m).orderBy("distance_m", "id").limit(limit)
    return nearest if raw_distance else nearest.drop("distance_m")


def geonear(df: DataFrame, lng: float, lat: float, radius_m: float, species=None,
            limit: int = DEFAULT_LIMIT) -> DataFrame:
    """As ``near``, with the distance in metres rounded to one decimal."""
    found = near(df, lng, lat, radius_m, species, limit, raw_distance=True)
    return found.withColumn("distance_m", F.round("distance_m", 1))


def inside_polygon(df: DataFrame, rings, species=None) -> DataFrame:
    """All sightings inside one polygon, unordered."""
    rings = checked_rings(df.sparkSession, rings)
    rows = _filter_species(df, species)
    edges, origin = G.constant_edges(rings), rings[0][0][0]
    wide = max(max(e["w"], e["e"]) for e in edges) - min(min(e["w"], e["e"]) for e in edges) >= 180
    if wide or len(edges) > _MAX_UNROLLED:
        table = [(0, [[{"lng": x, "lat": y} for x, y in ring] for ring in rings])]
        schema = "polygon_id int, rings array<array<struct<lng:double,lat:double>>>"
        return polygon_pairs(rows, df.sparkSession.createDataFrame(table, schema)).drop("polygon_id")
    lng, lat = F.col("lng"), F.col("lat")
    boxed = rows.filter(G.in_box(lng, lat, G.constant_box(edges, origin)))
    return boxed.filter(G.contains_constant(edges, origin, lng, lat))


def within(df: DataFrame, rings, species=None, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """The first ``limit`` sightings inside a polygon, by id."""
    return inside_polygon(df, rings, species).orderBy("id").limit(check_limit(limit))


def within_truncated(df: DataFrame, rings, species=None, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """How many rows ``within`` returns and whether there are more: at most ``limit + 1`` rows are looked at."""
    probe = inside_polygon(df, rings, species).select("id").limit(check_limit(limit) + 1)
    found = F.count(F.lit(1))
    return probe.agg(F.least(found, F.lit(limit)).alias("count"), (found > limit).alias("truncated"))


def within_total(df: DataFrame, rings, species=None) -> DataFrame:
    return inside_polygon(df, rings, species).agg(F.count(F.lit(1)).alias("total"))


def within_top_species(df: DataFrame, rings, k: int = 5) -> DataFrame:
    counts = inside_polygon(df, rings).groupBy("species_id").agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), "species_id").limit(k)


# ---- many queries at once -------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class _Cover:
    """The lattice cells of a request table, with what one small aggregate tells about them."""

    ranged: DataFrame
    levels: list[G.Level]
    found: list[G.Level]
    extent: dict[str, float] | None
    small: bool

    @staticmethod
    def of(boxes: DataFrame, row_bytes: Column, max_bytes: int, levels: list[G.Level] = G.LEVELS) -> _Cover:
        ranged = G.with_box_range(boxes, levels)
        rows = ranged.groupBy("level").agg(
            F.sum(F.col("cells") * row_bytes).alias("bytes"), F.min("south").alias("south"),
            F.max("north").alias("north"), F.min("west").alias("west"), F.max("east").alias("east")).collect()
        extent = {"south": min(r["south"] for r in rows), "north": max(r["north"] for r in rows),
                  "west": min(r["west"] for r in rows), "east": max(r["east"] for r in rows)} if rows else None
        found = list(dict.fromkeys(levels[r["level"]] for r in rows)) or levels[:1]
        return _Cover(ranged, levels, found, extent, sum(r["bytes"] for r in rows) <= max_bytes)

    def cells(self) -> DataFrame:
        return G.cover_cells(self.ranged, self.levels)

    def place(self, df: DataFrame) -> DataFrame:
        """Sightings in the extent of the requests, with their cell on every level that the requests use."""
        lng, lat = F.col("lng"), F.col("lat")
        if self.extent:
            df = df.filter(lat.between(self.extent["south"], self.extent["north"]))
            if self.extent["west"] >= -180 and self.extent["east"] <= 180:
                df = df.filter(lng.between(self.extent["west"], self.extent["east"]))
        keys = [level.of_point(lng, lat) for level in self.found]
        return df.withColumn("cell", keys[0] if len(keys) == 1 else F.explode(F.array(*keys)))


def _cell_join(df: DataFrame, cover: _Cover, salt_by: list[str], cells: DataFrame | None = None,
               more_keys: tuple[str, ...] = ()) -> DataFrame:
    """Pair every sighting with the boxes whose cells cover it: an equi-join on the lattice cell, and on ``more_keys`` of both.

    The request side is broadcast when the checked size of its cover allows; sightings are then never shuffled. Beyond
    it both sides are shuffled by cell, and a cell that holds more than 1/2000 of all sightings is split by a salt, so
    that no task receives more than about that share. The hint keeps Spark, which does not see that a cover has many times
    the rows of its table, from broadcasting it all the same.
    """
    on = ["cell", *more_keys]
    points, cells = cover.place(df), (cover.cells() if cells is None else cells).drop("cx", "cy", "deg")
    if cover.small:
        return points.join(F.broadcast(cells), on)
    share = max(1, df.count() // _HOT_SHARES)
    hot = (points.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > share)
           .select(*on, F.ceil(F.col("n") / share).alias("salts")))
    salts = F.coalesce(F.col("salts"), F.lit(1))
    # At most _HOT_SHARES cells per level (and kind of further key) pass the filter, whatever the size of the tables.
    points = points.join(F.broadcast(hot), on, "left") \
        .withColumn("salt", F.pmod(F.xxhash64(*salt_by), salts)).drop("salts")
    cells = cells.join(F.broadcast(hot), on, "left") \
        .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))).drop("salts")
    return points.join(cells.hint("merge"), [*on, "salt"]).drop("salt")


def thin_crowds(df: DataFrame, keep: int, by: list[str], crowd_rows: int = CROWD_ROWS) -> DataFrame:
    """Leave out rows that no ordered and limited answer can contain, where very many share one exact point.

    Rows at one point are equally far from anything and inside the same polygons, so only the first ``keep`` ids of a
    point (and of ``by``) can be returned. Only cells with more than ``crowd_rows`` rows and more than 1/2000 of the
    table are looked at, at most 2000 of them. The first ids are taken per group of input tasks and then over the
    groups: neither step brings more than ``keep`` rows of a point from any one task. With ``by``, the column ``_first``
    tells the rows that are among the first of their point whatever their ``by``.
    """
    placed = df.withColumn("_crowd", G.FINE_LEVELS[0].of_point(F.col("lng"), F.col("lat")))
    bound = max(crowd_rows, df.count() // _HOT_SHARES)
    crowded = materialize(
        placed.groupBy("_crowd").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > bound).select("_crowd"), "crowds")
    if crowded.isEmpty():
        return df
    thin = placed.join(F.broadcast(crowded), "_crowd", "left_anti")
    thick = placed.join(F.broadcast(crowded), "_crowd", "left_semi").withColumn(
        "_group", F.spark_partition_id() % _CROWD_GROUPS)
    for key in (["_group"], []):
        first = Window.partitionBy("lng", "lat", *by, *key).orderBy("id")
        thick = thick.withColumn("_nth", F.row_number().over(first)).filter(F.col("_nth") <= keep)
    if by:
        first = F.row_number().over(Window.partitionBy("lng", "lat").orderBy("id")) <= keep
        thin, thick = thin.withColumn("_first", F.lit(True)), thick.withColumn("_first", first)
    return thin.unionByName(thick.drop("_group", "_nth")).drop("_crowd")


def _kinds(table: DataFrame, ids: Column) -> DataFrame:
    """One row per species key in ``ids``: a species, or ``_ANY``."""
    return table.withColumn("_sp", F.explode(ids)).filter(F.col("_sp").isNotNull())


def _asked(queries: DataFrame) -> DataFrame:
    """One row per species that a request asks for, in place of ``species_ids``; one row with ``_ANY`` without a filter."""
    if "species_ids" not in queries.columns:
        return queries
    ids = F.col("species_ids")
    return _kinds(queries, F.when(ids.isNull(), F.array(F.lit(_ANY))).otherwise(
        F.array_distinct(ids.cast("array<long>")))).drop("species_ids")


def _species_keys() -> Column:
    """The keys under which a request can ask for a sighting."""
    return F.array(F.lit(_ANY), F.col("species_id").cast("long"))


def _boxed(queries: DataFrame) -> DataFrame:
    return queries.withColumns(G.circle_box(F.col("q_lng"), F.col("q_lat"), F.col("radius_m")))


def _request_bytes(queries: DataFrame) -> Column:
    """Bytes of a request in each of its cells."""
    if "species_ids" not in queries.columns:
        return F.lit(_NEAR_ROW_BYTES)
    return F.lit(_NEAR_ROW_BYTES) * F.greatest(F.lit(1), F.coalesce(F.size("species_ids"), F.lit(1)))


def _shrink(queries: DataFrame, proven: DataFrame) -> DataFrame:
    """Every radius, at most ``enough`` of the request. A metre of slack covers rounding."""
    return queries.join(proven, "_row", "left").withColumn(
        "radius_m", F.least(F.col("radius_m"), F.col("enough") + 1)).drop("enough")


def radius_of_own_cell(df: DataFrame, queries: DataFrame) -> DataFrame:
    """Shrink every radius to the farthest corner of the smallest cell around the request that holds ``limit`` sightings.

    One row per request, species and cell size, whatever the radius: a wide circle in a crowded place becomes a small one before
    its cells are listed. ``_row`` tells requests apart.
    """
    by_species = "species_ids" in queries.columns
    keys = ["step", "cx", "cy"] + (["_sp"] if by_species else [])

    def cells(table: DataFrame, lng: str, lat: str) -> DataFrame:
        at = [F.struct(F.lit(v.number).alias("step"), v.steps(F.col(lng) + 180).alias("cx"), v.steps(F.col(lat) + 90).alias("cy"),
                       F.lit(v.deg).alias("deg")) for v in G.AROUND]
        return table.select("*", F.inline(F.array(*at)))

    points = df.select("lng", "lat", *(["species_id"] if by_species else [])).filter("lng is not null and lat is not null")
    finest = G.AROUND[0]
    x, y = ((s + 0.5) * finest.deg for s in (finest.steps(F.col("lng") + 180), finest.steps(F.col("lat") + 90)))
    points = points.select(*points.columns[2:], (x - 180).alias("lng"), (y - 90).alias("lat"))
    points = points.groupBy(*points.columns).agg(F.count(F.lit(1)).alias("n"))
    counts = cells(_kinds(points, _species_keys()) if by_species else points, "lng", "lat").groupBy(*keys).agg(F.sum("n").alias("n"))
    asked = cells(_asked(queries), "q_lng", "q_lat").withColumn("far", G.farthest_m(F.col("q_lng"), F.col("q_lat")))
    found = asked.select("_row", "limit", "far", *keys).join(counts.hint("merge"), keys)
    enough = found.groupBy("_row", "limit", "far").agg(F.sum("n").alias("n")).filter(F.col("n") >= F.col("limit"))
    return _shrink(queries, enough.groupBy("_row").agg(F.min("far").alias("enough")))


def tighten_radius(df: DataFrame, queries: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Shrink every radius to where counts per small cell prove that ``limit`` sightings are closer.

    The nearest ``limit`` are all within that distance, ties included, so a request in a crowded place looks at little
    more than what it returns. Sightings are combined to one count per cell and species before any join. ``_row`` tells requests apart.
    """
    by_species = "species_ids" in queries.columns
    on = ["cell"] + (["_sp"] if by_species else [])
    cover = _Cover.of(_boxed(queries), _request_bytes(queries), max_bytes, G.FINE_LEVELS)
    counts = cover.place(df.select("lng", "lat", "species_id")).groupBy("cell", "species_id").agg(
        F.count(F.lit(1)).alias("n"))
    if by_species:
        counts = _kinds(counts, _species_keys())
    counts = counts.groupBy(*on).agg(F.sum("n").alias("n"))
    far = G.farthest_m(F.col("q_lng"), F.col("q_lat"))
    cells = _asked(cover.cells().withColumn("far", far)).select("_row", "limit", "far", *on)
    pairs = counts.join(F.broadcast(cells) if cover.small else cells.hint("merge"), on)
    by_cell = pairs.groupBy("_row", "limit", "far").agg(F.sum("n").alias("n"))
    outwards = Window.partitionBy("_row").orderBy("far").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    proven = by_cell.withColumn("within", F.sum("n").over(outwards)).filter(F.col("within") >= F.col("limit")) \
        .groupBy("_row").agg(F.min("far").alias("enough"))
    return _shrink(queries, proven)


def near_join(df: DataFrame, queries: DataFrame, max_bytes: int = BROADCAST_BYTES,
              crowd_rows: int = CROWD_ROWS) -> DataFrame:
    """For every request the nearest sightings within its radius: ``query_id, rank, distance_m`` and the sighting.

    ``queries``: ``query_id, q_lng, q_lat, radius_m, limit`` as accepted by the request checks, optionally
    ``species_ids`` (NULL = any species, an empty array matches nothing). The request table is written as given
    and after either tightening of its radii, because its cells depend on what is found in it. A request that asks for species is
    joined by cell and species.
    """
    numbered = materialize(spread(queries).withColumn("_row", F.monotonically_increasing_id()), "requests")
    own = materialize(spread(radius_of_own_cell(df, numbered)), "radii")
    tight = materialize(spread(tighten_radius(df, own, max_bytes)), "radii")
    cover = _Cover.of(_boxed(tight), _request_bytes(tight), max_bytes)
    highest = tight.agg(F.max("limit")).first()[0] or 1
    by_species = "species_ids" in queries.columns
    rows = thin_crowds(df, highest, ["species_id"] if by_species else [], crowd_rows)
    cells = _asked(cover.cells()).drop("_row")
    if by_species:
        rows = _kinds(rows, _species_keys())
    if "_first" in rows.columns:
        rows = rows.filter(F.col("_first") | (F.col("_sp") != _ANY)).drop("_first")
    pairs = _cell_join(rows, cover, ["id"], cells, ("_sp",) if by_species else ())
    lng, lat = F.col("lng"), F.col("lat")
    pairs = pairs.filter(G.in_box(lng, lat, {c: F.col(c) for c in ("south", "north", "west", "east")}))
    away = G.distance_m(F.col("q_lng"), F.col("q_lat"), lng, lat)
    close = pairs.withColumn("_away", away).filter(F.col("_away") <= F.col("radius_m")).select(
        "query_id", "limit", "_away", *df.columns)
    nearest_first = Window.partitionBy("query_id").orderBy("_away", "id")
    # The highest limit as a constant lets Spark cut each map task to that many rows per request before the shuffle.
    ranked = close.withColumn("rank", F.row_number().over(nearest_first)).filter(
        (F.col("rank") <= highest) & (F.col("rank") <= F.col("limit")))
    return ranked.select("query_id", "rank", F.round("_away", 1).alias("distance_m"), *df.columns)


def polygon_pairs(df: DataFrame, polygons: DataFrame, max_bytes: int = BROADCAST_BYTES,
                  salt_by: list[str] | None = None) -> DataFrame:
    """All (polygon, row) matches. ``polygons``: ``polygon_id, rings`` as accepted by the polygon checks."""
    prepared = materialize(G.prepare_polygons(spread(polygons)), "polygons")
    # Most cells need the few edges above their columns, counted twice here for the upper and the lower side.
    columns = F.col("cx1") - F.col("cx0") + 1
    edge_bytes = F.least(F.size("edges"), 4 + 2 * F.size("edges") / columns) * _EDGE_BYTES
    cover = _Cover.of(prepared, F.lit(_POLYGON_ROW_BYTES) + edge_bytes, max_bytes)
    whole, touched = G.cell_edges(F.col("edges"), F.col("origin"), F.col("pole"))
    cells = compute_once(cover.cells(), _whole=whole, _touched=touched).filter("_whole or size(_touched) > 0").select(
        "cell", "cx", "cy", "deg", "polygon_id", "origin", "_whole", "_touched")
    pairs = _cell_join(df.withColumn("_tan", F.tan(F.radians("lat"))), cover, salt_by or ["id"], cells)
    inside = G.contains(F.col("_touched"), F.col("_whole"), F.col("origin"), F.col("lng"), F.col("_tan"))
    return pairs.filter(inside).select("polygon_id", *df.columns)


def _id_ranges(df: DataFrame, first: int) -> list:
    """The last ids of growing ranges of ids, the first with about ``first`` rows; none for a table of few such ranges."""
    total = df.count()
    shares = []
    while total > first * _WIDER * 2 * _WIDER ** len(shares):
        shares.append(_WIDER ** -(len(shares) + 1))
    if not shares:
        return []
    some = df.select("id").filter(F.col("id").isNotNull() & (
        F.pmod(F.xxhash64("id"), F.lit(max(1, total // _CUT_IDS))) == 0))
    some = materialize(some, "ids")
    n = some.count()
    places = sorted({max(1, int(n * share)) for share in shares})
    numbered = some.withColumn("_nth", F.row_number().over(Window.orderBy("id")))
    return [r["id"] for r in numbered.filter(F.col("_nth").isin(places)).orderBy("id").collect()]


def within_join(df: DataFrame, polygons: DataFrame, limit: int = DEFAULT_LIMIT, max_bytes: int = BROADCAST_BYTES,
                crowd_rows: int = CROWD_ROWS, first_ids: int = FIRST_IDS) -> DataFrame:
    """The first ``limit`` sightings inside every polygon, by id, with their position in ``rank``.

    A large table is looked at in growing ranges of its first ids: polygons that find ``limit`` sightings in one are answered, the
    others go on to the next, which is the whole table in the end. So a polygon meets some times ``limit`` sightings, not all in it.
    """
    by_id, limit = Window.partitionBy("polygon_id").orderBy("id"), check_limit(limit)

    def first_of(rows: DataFrame, left: DataFrame) -> DataFrame:
        pairs = polygon_pairs(thin_crowds(rows, limit, [], crowd_rows), left, max_bytes)
        return pairs.withColumn("rank", F.row_number().over(by_id)).filter(F.col("rank") <= limit)

    answers, left = [], materialize(polygons, "polygons_left")
    for last in _id_ranges(df, first_ids):
        found = materialize(first_of(df.filter(F.col("id").isNull() | (F.col("id") <= F.lit(last))), left), "first_inside")
        full = found.filter(F.col("rank") == limit).select(F.col("polygon_id").alias("_full"))
        same = F.col("polygon_id").eqNullSafe(F.col("_full"))
        answers.append(found.join(full, same, "left_semi"))
        left = materialize(left.join(full, same, "left_anti"), "polygons_left")
    return reduce(DataFrame.unionByName, [*answers, first_of(df, left)])


def within_totals(df: DataFrame, polygons: DataFrame, max_bytes: int = BROADCAST_BYTES, leaf_places: int = LEAF_PLACES) -> DataFrame:
    """Number of sightings inside every polygon, also of those that hold none.

    Sightings are counted per place and per cell. A cell inside a polygon adds its count; one that an edge cuts is cut into smaller
    cells while it holds many places, and only the places of the last ones are tested. The work of a polygon grows with its rim.
    """
    polygons = materialize(polygons, "polygons_given")
    prepared = materialize(G.prepare_polygons(spread(polygons)), "polygons")
    cover = _Cover.of(prepared, F.lit(_POLYGON_ROW_BYTES), max_bytes)
    cuts = [v for v in G.CUTS if v.deg <= max(f.deg for f in cover.found)]
    cut = replace(cover, found=cuts, small=False)
    places = materialize(df.groupBy("lng", "lat").agg(F.count(F.lit(1)).alias("n")), "places")
    counts = materialize(cut.place(places).groupBy("cell").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("places")), "cells")
    cells = cover.cells().withColumn("start", F.col("pole"))
    sums, leaves = [], []
    for level in cuts:
        start, edges = G.cell_parts(F.col("edges"), F.col("origin"), F.col("start"))
        parts = compute_once(cells, start=start, edges=edges).withColumn("cut", F.exists("edges", lambda e: e["w"] < e["e"]))
        parts = parts.filter("start or cut").select("cell", "cx", "cy", "deg", "polygon_id", "origin", "start", "edges", "cut")
        # Cells without sightings leave here.
        parts = materialize(parts.hint("merge").join(counts, "cell"), "parts")
        sums.append(parts.filter("not cut").select("polygon_id", "n"))
        last = (F.col("places") <= leaf_places) | (F.col("deg") == cuts[-1].deg)
        leaves.append(parts.filter(F.col("cut") & last).drop("n", "places", "cut", "cx", "cy", "deg"))
        more = parts.filter(F.col("cut") & ~last).drop("n", "places", "cut", "cell")
        if more.isEmpty():
            break
        cells = G.cut_cells(spread(more)).withColumn("cell", G.cut_key())
    leaf = reduce(DataFrame.unionByName, leaves).withColumn("edges", F.filter("edges", lambda e: e["w"] < e["e"]))
    tested = _cell_join(places.withColumn("_tan", F.tan(F.radians("lat"))), cut, ["lng", "lat"], leaf)
    inside = G.contains(F.col("edges"), F.col("start"), F.col("origin"), F.col("lng"), F.col("_tan"))
    sums.append(tested.filter(inside).select("polygon_id", "n"))
    counted = reduce(DataFrame.unionByName, sums).groupBy("polygon_id").agg(F.sum("n").alias("n"))
    every = polygons.select("polygon_id").distinct()
    return every.join(counted, "polygon_id", "left").select("polygon_id", F.coalesce("n", F.lit(0).cast("long")).alias("count"))
