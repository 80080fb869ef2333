"""Grid aggregates and hotspots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roamgrid.functions.cells import (cell_center, cell_id, cell_polygon, chunk_bits, count_bits, merge_bits, species_bits,
                                      species_chunk, to_point, with_cell, with_species_count)
from roamgrid.operators.spatial import within_totals
from roamgrid.schemas import GRID_DEG, MAX_HOTSPOTS
from roamgrid.session import BROADCAST_ROWS
from roamgrid.sources.catalog import join_catalog


def agg_grid(df: DataFrame, deg: float = GRID_DEG) -> DataFrame:
    """Per cell: sightings, distinct species, distinct exact points.

    Two hash aggregates with map-side combine. The first is keyed by the exact point, so a crowded cell is spread over
    the cluster and a crowded point is combined before the shuffle; the second sees one row per point.
    """
    placed = with_cell(df.select("lng", "lat", "species_id"), deg)
    points = placed.groupBy("cx", "cy", "lng", "lat").agg(
        F.count(F.lit(1)).alias("n"), *merge_bits(species_bits(F.col("species_id"))))
    cells = points.groupBy("cx", "cy").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("distinct_points"), *merge_bits())
    counted = with_species_count(cells, placed, ["cx", "cy"], "species")
    shaped = cell_center(counted.withColumn("cell_id", cell_id()), deg)
    return shaped.select("cell_id", "cx", "cy", "count", "species", "distinct_points", "location", "lng_c", "lat_c")


def grid_bench(df: DataFrame, deg: float = GRID_DEG) -> DataFrame:
    """Per cell: sightings and distinct species, of one scan.

    A chunk of 192 ids is three words of bits. The known species are all in chunk 0, so a cell is one group of the first aggregate;
    other ids have chunks of their own, and the second aggregate adds the bits of the chunks.
    """
    placed = with_cell(df.select("lng", "lat", "species_id"), deg)
    chunks = placed.groupBy("cx", "cy", species_chunk(F.col("species_id")).alias("_chunk")).agg(
        F.count(F.lit(1)).alias("n"), *merge_bits(chunk_bits(F.col("species_id"))))
    return chunks.groupBy("cx", "cy").agg(F.sum("n").alias("size"), F.sum(count_bits()).alias("nunique"))


def grid_fingerprint(df: DataFrame, deg: float = GRID_DEG) -> DataFrame:
    return grid_bench(df, deg).agg(
        F.count(F.lit(1)).alias("cells"), F.sum("size").alias("total"), F.sum("nunique").alias("species_sum"))


def top_cells(grid: DataFrame, top: int = MAX_HOTSPOTS) -> DataFrame:
    """The ``top`` densest cells with their rank; ties in the text order of the cell id. Only these rows are ranked together."""
    if isinstance(top, bool) or not isinstance(top, int) or top < 1:
        raise ValueError("top must be a positive integer")
    order = [F.desc("count"), F.asc("cell_id")]
    return grid.orderBy(*order).limit(top).withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def hotspots(df: DataFrame, catalog: DataFrame, top: int = MAX_HOTSPOTS, deg: float = GRID_DEG,
             grid: DataFrame | None = None) -> DataFrame:
    """The densest cells with their three dominant species.

    The three are chosen by count and lower id, and listed by count and higher id. Pass ``grid`` to rank an aggregate
    table that is already written. Counts per cell and species are combined in one aggregate, and an array per cell (one entry
    per species of the catalog at most) is cut to three. Up to ``BROADCAST_ROWS`` ranked cells are broadcast.
    """
    ranked = top_cells(agg_grid(df, deg) if grid is None else grid, top)
    wanted = ranked.select("cx", "cy")
    counts = with_cell(df.select("lng", "lat", "species_id"), deg).join(
        F.broadcast(wanted) if top <= BROADCAST_ROWS else wanted, ["cx", "cy"], "left_semi").groupBy("cx", "cy", "species_id").count()
    named = join_catalog(counts.withColumnRenamed("count", "n"), catalog)
    listed = named.groupBy("cx", "cy").agg(F.collect_list(F.struct(
        F.col("n").alias("count"), "species_id", "name", "types")).alias("found"))

    def before(a: Column, b: Column) -> Column:
        return F.when(a["count"] != b["count"], F.when(a["count"] > b["count"], -1).otherwise(1)).otherwise(
            F.when(a["species_id"] < b["species_id"], -1).when(a["species_id"] > b["species_id"], 1).otherwise(0))

    leading = F.slice(F.array_sort("found", before), 1, 3)
    cells = ranked.join(listed, ["cx", "cy"]).withColumn("top_species", F.sort_array(leading, asc=False))
    point = to_point("lng_c", "lat_c")
    return cells.select("rank", "cell_id", "count", "species", "distinct_points", point.alias("location"), "lng_c", "lat_c",
                        "top_species")


def recount_hotspots(df: DataFrame, ranked: DataFrame, deg: float = GRID_DEG) -> DataFrame:
    """Count every hotspot again through the polygon of its cell; ``ranked`` has ``rank, count, lng_c, lat_c``."""
    squares = ranked.select(F.col("rank").alias("polygon_id"), cell_polygon(deg=deg).alias("rings"))
    recounted = within_totals(df, squares).select(F.col("polygon_id").alias("rank"), F.col("count").alias("recount"))
    both = ranked.select("rank", "cell_id", "count").join(recounted, "rank", "left")
    return both.withColumn("recount", F.coalesce("recount", F.lit(0).cast("long")))


def check_invariants(df: DataFrame, grid: DataFrame, time: DataFrame, species: DataFrame) -> DataFrame:
    """One row with the four totals that must agree."""
    hours = time.filter(F.col("granularity") == "hour")
    parts = {"total": df.select(F.lit(1).alias("count")), "grid": grid, "hours": hours, "species": species}
    sums = None
    for name, part in parts.items():
        one = part.agg(F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias("s")).select(F.lit(name).alias("k"), "s")
        sums = one if sums is None else sums.unionByName(one)
    row = sums.agg(*[F.max(F.when(F.col("k") == n, F.col("s"))).alias(n) for n in parts])
    agree = (F.col("total") == F.col("grid")) & (F.col("total") == F.col("hours")) & (F.col("total") == F.col("species"))
    return row.withColumn("agree", agree)
