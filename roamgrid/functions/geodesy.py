"""Spherical distance, geodesic polygons and the lattice that turns spatial joins into equi-joins."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roamgrid.functions.once import compute_once
from roamgrid.schemas import EARTH_RADIUS_M

# Degrees added around every box, far below a millimetre, so that rounding never loses a point on the rim.
_PAD = 1e-9


def distance_m(lng1: Column, lat1: Column, lng2: Column, lat2: Column) -> Column:
    """Great-circle distance in metres (haversine)."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lng = F.sin(F.radians(lng2 - lng1) / 2)
    h = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lng * half_lng
    return F.asin(F.sqrt(F.least(h, F.lit(1.0)))) * (2 * EARTH_RADIUS_M)


def circle_box(lng: Column, lat: Column, radius_m: Column) -> dict[str, Column]:
    """Bounding box of a circle. West and east are not wrapped; a circle that reaches a pole takes all longitudes."""
    angle = radius_m / EARTH_RADIUS_M
    south, north = lat - F.degrees(angle), lat + F.degrees(angle)
    polar = (south <= -90) | (north >= 90)
    half = F.degrees(F.asin(F.sin(angle) / F.cos(F.radians(lat))))
    return {
        "south": south - _PAD,
        "north": north + _PAD,
        "west": F.when(polar, F.lit(-180.0)).otherwise(lng - half - _PAD),
        "east": F.when(polar, F.lit(180.0)).otherwise(lng + half + _PAD),
    }


def in_box(lng: Column, lat: Column, box: dict[str, Column]) -> Column:
    """Plain comparisons only, so that a box of constants reaches the Parquet scan. Handles boxes across +-180."""
    west, east = box["west"], box["east"]
    inside = (lng >= west) & (lng <= east)
    wrapped = ((west < -180) & (lng >= west + 360)) | ((east > 180) & (lng <= east - 360))
    return (lat >= box["south"]) & (lat <= box["north"]) & (inside | wrapped)


# ---- polygons -------------------------------------------------------------------------------------------------------
# Edges are great circles. A point is inside when an odd number of edges lies north of it on its meridian; the edges of
# all rings go in one list, so a hole takes its area out by itself. Longitudes are relative to the first vertex, which
# keeps polygons across +-180 in one piece. A polygon of 180 degrees or more is measured from a line of the lattice, its edges
# are cut where they cross the opposite meridian, and the north pole counts as inside when the smaller side of its rings holds it.

def relative_lng(lng: Column, origin: Column) -> Column:
    return F.pmod(lng - origin + 180, F.lit(360.0)) - 180


def lng_span(rings: Column) -> Column:
    """Degrees of longitude between the outermost vertices, measured from the first one, so also across +-180."""
    places = F.transform(F.flatten(rings), lambda p: relative_lng(p["lng"], rings[0][0]["lng"]))
    return F.array_max(places) - F.array_min(places)


def polygon_edges(rings: Column, origin: Column) -> Column:
    """Edges as (west, east, tan of the latitude at either end, sine of the width); meridian edges never count."""
    def place(p: Column) -> Column:
        return F.struct(relative_lng(p["lng"], origin).alias("x"), F.tan(F.radians(p["lat"])).alias("t"))

    def edge(w: Column, tw: Column, e: Column, te: Column) -> Column:
        return F.struct(w.alias("w"), e.alias("e"), tw.alias("tw"), te.alias("te"), F.sin(F.radians(e - w)).alias("s"))

    def pieces(a: Column, b: Column) -> Column:
        west, east = F.when(a["x"] <= b["x"], a).otherwise(b), F.when(a["x"] <= b["x"], b).otherwise(a)
        # The shorter way leads over the meridian at 180 degrees from the origin, from the eastern end on.
        begin, end = east["x"], west["x"] + 360
        at_seam = (F.sin(F.radians(end - 180)) * east["t"] + F.sin(F.radians(180 - begin)) * west["t"]) / F.sin(F.radians(end - begin))
        return F.when(end - begin < 180, F.array(edge(begin, east["t"], F.lit(180.0), at_seam), edge(F.lit(-180.0), at_seam, west["x"], west["t"]))) \
            .otherwise(F.array(edge(west["x"], west["t"], east["x"], east["t"])))

    def ring_edges(ring: Column) -> Column:
        n, placed = F.size(ring) - 1, F.transform(ring, place)
        return F.flatten(F.zip_with(F.slice(placed, 1, n), F.slice(placed, 2, n), pieces))

    return F.flatten(F.transform(rings, ring_edges))


def poles_inside(rings: Column) -> tuple[Column, Column]:
    """Whether the north and the south pole are inside; the inside of a ring is its smaller side.

    Areas between edges and the equator add up to the area of the side that does not hold the north pole, less the southern half
    globe if the ring goes around the poles. Of two equal sides, the one to the left of the ring is meant.
    """
    def step(a: Column, b: Column) -> Column:
        turn = relative_lng(b["lng"], a["lng"])
        ua, ub = F.tan(F.radians(a["lat"]) / 2), F.tan(F.radians(b["lat"]) / 2)
        return F.struct(turn.alias("turn"), (F.atan2(F.tan(F.radians(turn) / 2) * (ua + ub), ua * ub + 1) * 2).alias("area"))

    def sums(ring: Column) -> Column:
        n, zero = F.size(ring) - 1, F.struct(F.lit(0.0).alias("turn"), F.lit(0.0).alias("area"))
        return F.aggregate(F.zip_with(F.slice(ring, 1, n), F.slice(ring, 2, n), step), zero, lambda s, e: F.struct(
            (s["turn"] + e["turn"]).alias("turn"), (s["area"] + e["area"]).alias("area")))

    def northern(r: Column) -> Column:
        around = F.abs(r["turn"]) > 180
        side = F.when(around, F.signum(r["turn"]) * r["area"]).otherwise(F.abs(r["area"]) - 2 * math.pi)
        return F.when(F.abs(side) < 1e-9, F.when(around, r["turn"] > 0).otherwise(r["area"] > 0)).otherwise(side > 0)

    rings = F.transform(rings, sums)
    north = F.aggregate(rings, F.lit(False), lambda odd, r: odd != northern(r))
    return north, F.aggregate(rings, north, lambda odd, r: odd != (F.abs(r["turn"]) > 180))


def constant_edges(rings: list[list[tuple[float, float]]]) -> list[dict]:
    """The same edges of one known polygon. Their ends are numbers and everything else folds to constants."""
    origin = rings[0][0][0]
    edges = []
    for ring in rings:
        placed = [((lng - origin + 180) % 360 - 180, lat) for lng, lat in ring]
        for a, b in zip(placed, placed[1:]):
            (w, south), (e, north) = sorted([a, b])
            edges.append({"w": w, "e": e, "tw": F.tan(F.radians(F.lit(south))), "te": F.tan(F.radians(F.lit(north))),
                          "s": F.sin(F.radians(F.lit(e - w)))})
    return edges


def edge_north_of(edge, x: Column, tan_lat: Column) -> Column:
    """Whether the edge passes north of a point. ``edge`` is a struct column or an entry of ``constant_edges``."""
    w, e, tw, te, s = (edge[k] for k in ("w", "e", "tw", "te", "s"))
    at_x = (F.sin(F.radians(e - x)) * tw + F.sin(F.radians(x - w)) * te) / s
    return (x >= w) & (x < e) & (tan_lat < at_x)


def contains(edges: Column, whole: Column, origin: Column, lng: Column, tan_lat: Column) -> Column:
    """Whether an odd number of edges passes north of a point; ``whole`` is what the edges left out add up to."""
    x = relative_lng(lng, origin)
    return F.aggregate(edges, whole, lambda odd, e: odd != edge_north_of(e, x, tan_lat))


def contains_constant(edges: list[dict], origin: float, lng: Column, lat: Column) -> Column:
    """The same test against one known polygon, unrolled into plain expressions that code generation covers."""
    x, tan_lat = relative_lng(lng, F.lit(origin)), F.tan(F.radians(lat))
    crossings = [edge_north_of(e, x, tan_lat).cast("int") for e in edges if e["w"] < e["e"]]
    return reduce(lambda a, b: a + b, crossings) % 2 == 1


def constant_box(edges: list[dict], origin: float) -> dict[str, Column]:
    """Bounding box of one known polygon, bulges included."""
    return {"south": F.least(*[_edge_top(e, -1) for e in edges]) - _PAD,
            "north": F.greatest(*[_edge_top(e, 1) for e in edges]) + _PAD,
            "west": F.lit(origin + min(e["w"] for e in edges) - _PAD),
            "east": F.lit(origin + max(e["e"] for e in edges) + _PAD)}


def _edge_top(e: Column, sign: int) -> Column:
    """Northernmost (sign 1) or southernmost (sign -1) latitude of one edge: a great circle bulges towards the pole."""
    width = F.radians(F.lit(e["e"] - e["w"]) if isinstance(e["w"], float) else e["e"] - e["w"])
    rise = (e["te"] - e["tw"] * F.cos(width)) * sign
    fall = (e["te"] * F.cos(width) - e["tw"]) * sign
    steepest = F.sqrt(e["tw"] * e["tw"] + e["te"] * e["te"] - e["tw"] * e["te"] * F.cos(width) * 2) / e["s"]
    ends = F.greatest(e["tw"] * sign, e["te"] * sign)
    inner = (e["s"] > 0) & (rise > 0) & (fall < 0)
    return F.degrees(F.atan(F.when(inner, steepest).otherwise(ends))) * sign


def prepare_polygons(polygons: DataFrame) -> DataFrame:
    """Replace ``rings`` by ``origin, edges``, whether the north pole is inside (``pole``), and a bounding box that includes the bulge
    of the edges.

    The box of a polygon with a pole inside takes all longitudes. Boxes of wide polygons end at 180 degrees from the origin, a line
    of the largest lattice.
    """
    first, wide = F.col("rings")[0][0]["lng"], lng_span(F.col("rings")) >= 180
    largest = LEVELS[-1].deg
    with_origin = compute_once(polygons, wide=wide, origin=F.when(wide, F.round(first / largest) * largest).otherwise(first))
    north, south = poles_inside(F.col("rings"))
    no = F.lit(False)
    with_edges = compute_once(with_origin, edges=polygon_edges(F.col("rings"), F.col("origin")), pole=F.when(F.col("wide"), north).otherwise(no),
                              south_pole=F.when(F.col("wide"), south).otherwise(no)).drop("rings")
    ranged = F.transform("edges", lambda e: e.withField("top", _edge_top(e, 1)).withField("low", _edge_top(e, -1)))
    with_edges = compute_once(with_edges, edges=ranged)
    edges, any_pole = F.col("edges"), F.col("pole") | F.col("south_pole")
    west, east = F.array_min(F.transform(edges, lambda e: e["w"])) - _PAD, F.array_max(F.transform(edges, lambda e: e["e"])) + _PAD
    full = F.lit(180.0)
    return compute_once(
        with_edges,
        south=F.when(F.col("south_pole"), F.lit(-90.0)).otherwise(F.array_min(F.transform(edges, lambda e: e["low"])) - _PAD),
        north=F.when(F.col("pole"), F.lit(90.0)).otherwise(F.array_max(F.transform(edges, lambda e: e["top"])) + _PAD),
        west=F.col("origin") + F.when(any_pole, -full).when(F.col("wide"), F.greatest(west, -full)).otherwise(west),
        east=F.col("origin") + F.when(any_pole, full).when(F.col("wide"), F.least(east, full)).otherwise(east)).drop("wide", "south_pole")


# ---- lattice --------------------------------------------------------------------------------------------------------

# Every lattice is made of whole cells of the smallest one, so a point lies in one cell of each and these are nested.
SMALLEST_DEG = 0.00025


@dataclass(frozen=True)
class Level:
    """One lattice of square cells covering the globe; ``number`` keeps the keys of the levels apart."""

    number: int
    deg: float

    @property
    def columns(self) -> int:
        return round(360 / self.deg)

    def key(self, cx: Column, cy: Column) -> Column:
        return cy * self.columns + cx + self.number * 10**13

    def steps(self, degrees: Column) -> Column:
        """Number of the column or row at so many degrees from the lattice's edge."""
        return F.floor(F.floor(degrees / F.lit(SMALLEST_DEG)) / F.lit(round(self.deg / SMALLEST_DEG)))

    def of_point(self, lng: Column, lat: Column) -> Column:
        return self.key(F.pmod(self.steps(lng + 180), F.lit(self.columns).cast("long")), self.steps(lat + 90))


# Small boxes use small cells: candidates stay close to matches, and a box covers about a dozen cells. Boxes from 1.5 to 15
# degrees cover up to 1,000 cells, wider ones at most the 2,592 cells of the whole largest lattice.
LEVELS = [Level(5, 0.001), Level(3, 0.004), Level(0, 0.02), Level(1, 0.1), Level(2, 0.5), Level(4, 5.0)]
_WIDEST = [*[3 * level.deg for level in LEVELS[:4]], 30 * LEVELS[4].deg]
# Up to one step finer for the same boxes, for counts rather than rows: some hundred cells per box, and for a circle at a pole,
# which is 360 degrees wide and less than one high, about 1,500.
FINE_LEVELS = [LEVELS[0], LEVELS[1], LEVELS[1], LEVELS[2], LEVELS[3], LEVELS[4]]
# The levels by which a cell is cut further, from the largest to the smallest.
CUTS = [*reversed(LEVELS), Level(6, SMALLEST_DEG)]
# Cells around a place from 50 m to 3.5 km wide, each twice as wide as the one before.
AROUND = [Level(10 + i, 0.0005 * 2**i) for i in range(7)]


def box_level() -> Column:
    """Lattice level for the box columns of a row."""
    span = F.greatest(F.col("north") - F.col("south"), F.col("east") - F.col("west"))
    return reduce(lambda level, i: F.when(span <= _WIDEST[i], i).otherwise(level), reversed(range(len(_WIDEST))), F.lit(len(_WIDEST)))


def _by_level(levels: list[Level], make) -> Column:
    return reduce(lambda other, i: F.when(F.col("level") == i, make(levels[i])).otherwise(other),
                  range(len(levels) - 1), make(levels[-1]))


def with_box_range(boxes: DataFrame, levels: list[Level] = LEVELS) -> DataFrame:
    """Add the level, the lattice rows and columns of the box, and how many cells it covers."""
    deg = _by_level(levels, lambda v: F.lit(v.deg))
    ranged = boxes.withColumn("level", box_level()).withColumn("deg", deg).withColumns({
        "cx0": F.floor((F.col("west") + 180) / F.col("deg")),
        "cx1": F.floor((F.col("east") + 180) / F.col("deg")),
        "cy0": F.floor((F.greatest(F.col("south"), F.lit(-90.0)) + 90) / F.col("deg")),
        "cy1": F.floor((F.least(F.col("north"), F.lit(90.0)) + 90) / F.col("deg")),
        "across": _by_level(levels, lambda v: F.lit(v.columns).cast("long")),
    })
    ranged = ranged.withColumn("cx1", F.least(F.col("cx1"), F.col("cx0") + F.col("across") - 1))
    cells = (F.col("cx1") - F.col("cx0") + 1) * (F.col("cy1") - F.col("cy0") + 1)
    return ranged.withColumn("cells", cells)


def cover_cells(ranged: DataFrame, levels: list[Level] = LEVELS) -> DataFrame:
    """One row per box and covered cell: the cell key in ``cell``, its place in ``cx, cy, deg``."""
    rows = ranged.withColumn("cy", F.explode(F.sequence("cy0", "cy1")))
    cells = rows.withColumn("cx", F.explode(F.sequence("cx0", "cx1")))
    key = _by_level(levels, lambda v: v.key(F.pmod(F.col("cx"), F.col("across")), F.col("cy")))
    return cells.withColumn("cell", key).drop("level", "cx0", "cx1", "cy0", "cy1", "across", "cells")


def _cell_box(origin: Column) -> tuple[Column, ...]:
    """West, east and middle of the cell ``cx, cy, deg``, as degrees from ``origin``, and its south and north."""
    middle = F.col("cx") * F.col("deg") - 180 - origin + F.col("deg") / 2
    south = F.col("cy") * F.col("deg") - 90 - _PAD
    return (middle - F.col("deg") / 2 - _PAD, middle + F.col("deg") / 2 + _PAD, middle, south, south + F.col("deg") + 2 * _PAD)


def cell_edges(edges: Column, origin: Column, pole: Column | None = None) -> tuple[Column, Column]:
    """What of a polygon the cell ``cx, cy, deg`` of its cover needs: a start value for the count of edges north of a point, and
    the edges that still have to be looked at. ``pole`` tells whether the north pole is inside.

    Edges beside or south of the cell never count. If no edge comes down to the cell, it is inside or outside as a whole, as its
    middle is, and needs no edges. Otherwise edges north of it that span all its columns are counted beforehand.
    """
    x0, x1, middle, south, north = _cell_box(origin)

    def counts(e: Column) -> Column:
        return (e["w"] < e["e"]) & (e["w"] < x1) & (e["e"] > x0) & (e["top"] >= south)

    def always(e: Column) -> Column:
        return (e["w"] <= x0) & (e["e"] >= x1) & (e["low"] > north)

    # A meridian edge never counts, but it can divide a cell.
    crossed = F.exists(edges, lambda e: (e["w"] < x1) & (e["e"] > x0) & (e["top"] >= south) & (e["low"] <= north))
    at_middle = F.size(F.filter(edges, lambda e: counts(e) & (e["w"] <= middle) & (middle < e["e"]))) % 2 == 1
    whole = F.size(F.filter(edges, lambda e: counts(e) & always(e))) % 2 == 1
    return (F.when(crossed, whole).otherwise(at_middle) != (F.lit(False) if pole is None else pole),
            F.when(crossed, F.filter(edges, lambda e: counts(e) & ~always(e))).otherwise(F.slice(edges, 1, 0)))


def cut_cells(cells: DataFrame) -> DataFrame:
    """The cells of the next smaller lattice that make up the cells ``cx, cy, deg``; of the smallest there are none."""
    made = None
    for large, small in zip(CUTS, CUTS[1:]):
        n = round(large.deg / small.deg)
        part = F.struct((F.col("cx") * n).alias("x"), (F.col("cy") * n).alias("y"), F.lit(n - 1).alias("last"), F.lit(small.deg).alias("deg"))
        made = (F if made is None else made).when(F.col("deg") == large.deg, part)
    parts = cells.withColumn("_part", made).filter(F.col("_part").isNotNull()).drop("deg").withColumn("deg", F.col("_part.deg"))
    for c, start in (("cx", "x"), ("cy", "y")):
        parts = parts.withColumn(c, F.explode(F.sequence(F.col(f"_part.{start}"), F.col(f"_part.{start}") + F.col("_part.last"))))
    return parts.drop("_part")


def cut_key() -> Column:
    """The key of the cell ``cx, cy, deg``."""
    key = F
    for level in CUTS:
        key = key.when(F.col("deg") == level.deg, level.key(F.pmod("cx", F.lit(level.columns).cast("long")), F.col("cy")))
    return key


def cell_parts(edges: Column, origin: Column, start: Column) -> tuple[Column, Column]:
    """What the cell ``cx, cy, deg`` takes over from the cell that it is cut from (``start`` and ``edges``), so that it can be cut further:
    the start value for the count of edges north of a point, and the edges in it or north of a part of its columns.

    In a cell without edges all points are inside or outside, as the start value says. Unlike ``cell_edges`` this keeps edges along
    meridians, which divide cells: they are left out when points are tested.
    """
    x0, x1, middle, south, north = _cell_box(origin)

    def counts(e: Column) -> Column:
        return (e["w"] < e["e"]) & (e["w"] < x1) & (e["e"] > x0) & (e["top"] >= south)

    def always(e: Column) -> Column:
        return (e["w"] <= x0) & (e["e"] >= x1) & (e["low"] > north)

    def crosses(e: Column) -> Column:
        return (e["w"] < x1) & (e["e"] > x0) & (e["top"] >= south) & (e["low"] <= north)

    crossed = F.exists(edges, crosses)
    at_middle = F.size(F.filter(edges, lambda e: counts(e) & (e["w"] <= middle) & (middle < e["e"]))) % 2 == 1
    whole = F.size(F.filter(edges, lambda e: counts(e) & always(e))) % 2 == 1
    near = F.when(crossed, F.filter(edges, lambda e: crosses(e) | (counts(e) & ~always(e)))).otherwise(F.slice(edges, 1, 0))
    return F.when(crossed, whole).otherwise(at_middle) != start, near


def farthest_m(lng: Column, lat: Column) -> Column:
    """Distance from a point to the farthest corner of the cell ``cx, cy, deg``; no place in the cell is farther."""
    west, south = F.col("cx") * F.col("deg") - 180, F.col("cy") * F.col("deg") - 90
    east, north = west + F.col("deg"), F.least(south + F.col("deg"), F.lit(90.0))
    return F.greatest(*[distance_m(lng, lat, x, y) for x in (west, east) for y in (south, north)])
