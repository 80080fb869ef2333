"""Listings over the aggregate tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roamgrid.functions.cells import to_point
from roamgrid.functions.times import iso_z
from roamgrid.operators.spatial import check_limit, check_species
from roamgrid.operators.temporal import GRANULARITIES
from roamgrid.schemas import MAX_GRID_ROWS, MAX_HOTSPOTS, MAX_SPECIES
from roamgrid.sources.catalog import enrich


def list_hotspots(hot: DataFrame, limit: int = 20) -> DataFrame:
    return hot.orderBy("rank").limit(check_limit(limit, MAX_HOTSPOTS))


def bbox_filter(grid: DataFrame, min_lat: float | None = None, max_lat: float | None = None,
                min_lng: float | None = None, max_lng: float | None = None) -> DataFrame:
    """Cells whose centre is in the box; every side is optional and inclusive."""
    for column, low, high in (("lat_c", min_lat, max_lat), ("lng_c", min_lng, max_lng)):
        if low is not None:
            grid = grid.filter(F.col(column) >= float(low))
        if high is not None:
            grid = grid.filter(F.col(column) <= float(high))
    return grid


def list_grid(grid: DataFrame, limit: int = 50, **box: float | None) -> DataFrame:
    return bbox_filter(grid, **box).orderBy(F.desc("count"), "cell_id").limit(check_limit(limit, MAX_GRID_ROWS))


def list_time(time: DataFrame, granularity: str = "hour") -> DataFrame:
    if granularity not in GRANULARITIES:
        raise ValueError(f"granularity must be one of {GRANULARITIES}")
    return time.filter(F.col("granularity") == granularity).orderBy("key")


def list_types(types: DataFrame) -> DataFrame:
    return types.orderBy(F.desc("count"), "type")


def list_species(species: DataFrame, limit: int = 20) -> DataFrame:
    return species.orderBy(F.desc("count"), "species_id").limit(check_limit(limit, MAX_SPECIES))


def list_species_hours(species_hour: DataFrame, catalog: DataFrame, species_id: int) -> DataFrame:
    hours = species_hour.filter(F.col("species_id") == check_species(species_id))
    return enrich(hours, catalog).select("species_id", "name", "local_hour", "count").orderBy("local_hour")


def heat(grid: DataFrame, limit: int = MAX_GRID_ROWS, **box: float | None) -> DataFrame:
    """Intensity of the listed cells: the square root of the count over the highest listed count (at least 1)."""
    listed = list_grid(grid, limit, **box)
    top = F.greatest(F.max("count").over(Window.partitionBy(F.lit(1))), F.lit(1))
    return listed.select("cell_id", "lat_c", "lng_c", F.sqrt(F.col("count") / top).alias("intensity"))


def share_of_max(listing: DataFrame) -> DataFrame:
    """Percentage of the leader for every row of a limited listing."""
    return listing.withColumn("pct_of_max", F.col("count") * 100 / F.max("count").over(Window.partitionBy(F.lit(1))))


def shape_record(df: DataFrame, catalog: DataFrame) -> DataFrame:
    """The output record of a spatial query: catalog names, GeoJSON location, ISO time, distance to one decimal."""
    named = enrich(df, catalog)
    columns = ["id", "species_id", "name", "types", "source", to_point("lng", "lat").alias("location"),
               iso_z(F.col("appeared_utc")).alias("appeared_utc"), "local_date", "local_hour", "local_dow"]
    if "distance_m" in df.columns:
        columns.append(F.round("distance_m", 1).alias("distance_m"))
    return named.select(*columns)
