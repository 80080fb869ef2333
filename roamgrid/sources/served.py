"""Lookups and listings of stored tables by their manifests."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roamgrid.functions.cells import curve_key
from roamgrid.operators.listings import heat, list_grid
from roamgrid.operators.spatial import check_limit, geonear, near, within
from roamgrid.schemas import EARTH_RADIUS_M, MAX_GRID_ROWS
from roamgrid.sources.manifest import Served, box_facts, describe
from roamgrid.sources.store import from_documents


def _boxes(lng: float, lat: float, radius_m: float) -> list[tuple[float, float, float, float]]:
    """``west, south, east, north`` boxes that hold a circle; two across the date line, a whole band at a pole."""
    angle = radius_m / EARTH_RADIUS_M + 1e-9
    south, north = lat - math.degrees(angle), lat + math.degrees(angle)
    if south <= -90 or north >= 90 or math.sin(angle) >= math.cos(math.radians(lat)):
        return [(-180.0, south, 180.0, north)]
    half = math.degrees(math.asin(math.sin(angle) / math.cos(math.radians(lat))))
    west, east = lng - half, lng + half
    boxes = [(max(west, -180.0), south, min(east, 180.0), north)]
    if west < -180:
        boxes.append((west + 360, south, 180.0, north))
    if east > 180:
        boxes.append((-180.0, south, east - 360, north))
    return boxes


class ServedDocuments(Served):
    """Point and polygon lookups on the document table, as ``near``, ``geonear`` and ``within`` of all its rows."""

    def _rows(self, boxes: list[tuple[float, float, float, float]]) -> DataFrame:
        return from_documents(self.read(r["file"] for r in self.overlapping(boxes)))

    def near(self, lng: float, lat: float, radius_m: float, **options) -> DataFrame:
        return near(self._around(lng, lat, radius_m), lng, lat, radius_m, **options)

    def geonear(self, lng: float, lat: float, radius_m: float, **options) -> DataFrame:
        return geonear(self._around(lng, lat, radius_m), lng, lat, radius_m, **options)

    def _around(self, lng: float, lat: float, radius_m: float) -> DataFrame:
        numbers = all(isinstance(x, (int, float)) and math.isfinite(x) for x in (lng, lat, radius_m))
        # What is no circle is refused by the operator, with its own message.
        return self._rows(_boxes(lng, lat, radius_m) if numbers else [])

    def within(self, rings, **options) -> DataFrame:
        """Edges are geodesic and rise above their ends: latitudes are widened to the highest a side of that length can reach."""
        try:
            lngs, lats = zip(*((float(x), float(y)) for ring in rings for x, y in ring))
            span = max(lngs) - min(lngs)
        except (TypeError, ValueError):
            return within(self._rows([]), rings, **options)
        if span >= 90 or not lngs:
            return within(self._rows([(-180.0, -90.0, 180.0, 90.0)]), rings, **options)
        reach = [math.degrees(math.atan(math.tan(math.radians(x)) / math.cos(math.radians(span / 2)))) if abs(x) < 90 else x for x in lats]
        box = (min(lngs), min(*lats, *reach) - 1e-9, max(lngs), max(*lats, *reach) + 1e-9)
        return within(self._rows([box]), rings, **options)


def write_grid(grid: DataFrame, path: str, parts: int | None = None) -> None:
    """Write a grid aggregate for listings: cells of like count together, and in the order of the curve among these."""
    banded = grid.withColumns({"_band": -F.floor(F.log2(F.greatest("count", F.lit(1)))), "_curve": curve_key("lng_c", "lat_c")})
    keys = ["_band", "_curve", "cell_id"]
    placed = banded.repartitionByRange(*keys) if parts is None else banded.repartitionByRange(parts, *keys)
    placed.sortWithinPartitions(*keys).drop("_band", "_curve").write.mode("overwrite").parquet(path)
    describe(grid.sparkSession, path, *box_facts("lng_c", "lat_c"), F.min("count").alias("least"), F.max("count").alias("most"))


class ServedGrid(Served):
    """Listings of the grid aggregate, as ``list_grid`` and ``heat`` of all its rows."""

    def top_files(self, limit: int, min_lat: float | None = None, max_lat: float | None = None, min_lng: float | None = None,
                  max_lng: float | None = None) -> list[str]:
        """The files that may hold one of the first ``limit`` cells of the box.

        Files that lie in the box whole and hold ``limit`` cells of at least some count prove that no cell below that count is listed.
        """
        west, south = (-math.inf if x is None else float(x) for x in (min_lng, min_lat))
        east, north = (math.inf if x is None else float(x) for x in (max_lng, max_lat))
        near_box = self.overlapping([(west, south, east, north)])
        inside = [r for r in near_box if west <= r["west"] and r["east"] <= east and south <= r["south"] and r["north"] <= north]
        proven, least = 0, 0
        for r in sorted(inside, key=lambda r: -r["least"]):
            proven += r["rows"]
            if proven >= limit:
                least = r["least"]
                break
        return [r["file"] for r in near_box if r["most"] >= least]

    def list_grid(self, limit: int = 50, **box: float | None) -> DataFrame:
        return list_grid(self.read(self.top_files(check_limit(limit, MAX_GRID_ROWS), **box)), limit, **box)

    def heat(self, limit: int = MAX_GRID_ROWS, **box: float | None) -> DataFrame:
        return heat(self.read(self.top_files(check_limit(limit, MAX_GRID_ROWS), **box)), limit, **box)


def write_time(time: DataFrame, path: str) -> None:
    """Write the time aggregate with a folder for each granularity, so that a listing reads one of them."""
    time.repartition("granularity").sortWithinPartitions("key").write.mode("overwrite").partitionBy("granularity").parquet(path)
