"""Counts by species, species and hour, and type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roamgrid.schemas import MAX_SPECIES, MIN_SPECIES
from roamgrid.sources.catalog import join_catalog


def agg_species(df: DataFrame, catalog: DataFrame) -> DataFrame:
    return name_species(df.groupBy("species_id").agg(F.count(F.lit(1)).alias("count")), catalog)


def species_from_hours(species_hour: DataFrame, catalog: DataFrame) -> DataFrame:
    """The same table from counts per species and hour, without another scan of the sightings."""
    return name_species(species_hour.groupBy("species_id").agg(F.sum("count").alias("count")), catalog)


def name_species(counts: DataFrame, catalog: DataFrame) -> DataFrame:
    return join_catalog(counts, catalog).select("species_id", "name", "types", "count")


def agg_species_hour(df: DataFrame) -> DataFrame:
    return df.groupBy("species_id", "local_hour").agg(F.count(F.lit(1)).alias("count"))


def agg_type(species: DataFrame) -> DataFrame:
    """From species counts; a species with two types counts under both."""
    return species.select(F.explode("types").alias("type"), "count").groupBy("type").agg(F.sum("count").alias("count"))


def species_audit(df: DataFrame) -> DataFrame:
    """Range of the integer ids of raw rows, before any rule: min, max, distinct, outside the domain, absent."""
    counts = df.groupBy("species_id").agg(F.count(F.lit(1)).alias("n"))
    species = F.col("species_id")
    return counts.agg(
        F.sum("n").alias("rows"), F.min(species).alias("min_id"), F.max(species).alias("max_id"),
        F.count(species).alias("distinct_ids"),
        F.coalesce(F.sum(F.when(~species.between(MIN_SPECIES, MAX_SPECIES), F.col("n"))), F.lit(0)).alias("outside"),
        F.coalesce(F.sum(F.when(species.isNull(), F.col("n"))), F.lit(0)).alias("without_id"),
    )
