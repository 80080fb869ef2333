"""The six aggregate tables of a document table, with the check that their sums agree.

    python -m roamgrid.plans.aggregate DOCUMENTS CATALOG_JSON OUT [--deg 0.01] [--top 200]
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roamgrid.operators.grid import agg_grid, check_invariants, hotspots
from roamgrid.operators.species import agg_species_hour, agg_type, species_from_hours
from roamgrid.operators.temporal import agg_time
from roamgrid.schemas import GRID_DEG, MAX_HOTSPOTS
from roamgrid.session import drop_intermediate, use_utc
from roamgrid.sources.catalog import read_catalog
from roamgrid.sources.served import write_grid, write_time
from roamgrid.sources.store import from_documents, read_table, write_table


def _keyed(df: DataFrame, key) -> DataFrame:
    return df.select(key.alias("_id"), *df.columns)


def aggregate(sightings: DataFrame, catalog: DataFrame, out: str, deg: float = GRID_DEG,
              top: int = MAX_HOTSPOTS) -> dict[str, DataFrame]:
    """Write all tables and return them as read back. Smaller tables come from larger ones that are already written:
    species from species and hours, types from species, hotspots from the grid."""
    def write(name: str, df: DataFrame, key) -> DataFrame:
        return write_table(_keyed(df, key), out, name)

    # The two tables that are listed by box and by granularity have a layout of their own.
    spark, root = sightings.sparkSession, out.rstrip("/")
    write_grid(_keyed(agg_grid(sightings, deg), F.col("cell_id")), f"{root}/agg_grid")
    tables = {"agg_grid": read_table(spark, root, "agg_grid")}
    tables["agg_hotspots"] = write(
        "agg_hotspots", hotspots(sightings, catalog, top, deg, tables["agg_grid"]), F.col("rank"))
    write_time(_keyed(agg_time(sightings), F.concat_ws(":", "granularity", "key")), f"{root}/agg_time")
    tables["agg_time"] = read_table(spark, root, "agg_time")
    hours = write("agg_species_hour", agg_species_hour(sightings), F.concat_ws(":", "species_id", "local_hour"))
    tables["agg_species_hour"] = hours
    tables["agg_species"] = write("agg_species", species_from_hours(hours, catalog), F.col("species_id"))
    tables["agg_type"] = write("agg_type", agg_type(tables["agg_species"]), F.col("type"))

    sums = check_invariants(sightings, tables["agg_grid"], tables["agg_time"], tables["agg_species"]).first()
    if not sums["agree"]:
        raise ValueError(f"the aggregates do not add up to the sightings: {sums.asDict()}")
    return tables


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("documents")
    parser.add_argument("catalog")
    parser.add_argument("out")
    parser.add_argument("--deg", type=float, default=GRID_DEG)
    parser.add_argument("--top", type=int, default=MAX_HOTSPOTS)
    args = parser.parse_args()
    spark = use_utc(SparkSession.builder.appName("roamgrid-aggregate").getOrCreate())
    sightings = from_documents(spark.read.parquet(args.documents))
    for name, table in aggregate(sightings, read_catalog(spark, args.catalog), args.out, args.deg, args.top).items():
        print(f"{name}: {table.count():,} rows")
    drop_intermediate(spark)


if __name__ == "__main__":
    main()
