"""Species catalog: reading, shaping, joining."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roamgrid.schemas import CATALOG, MAX_SPECIES, MIN_SPECIES, RAW_SPECIES, SPECIES_RESPONSE, STAT_NAMES


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """One JSON array of species, keyed by ``species_id`` or by the key of the raw export."""
    both = T.StructType([*CATALOG.fields, T.StructField(RAW_SPECIES, T.IntegerType())])
    rows = spark.read.schema(both).option("multiLine", True).json(path)
    return rows.withColumn("species_id", F.coalesce("species_id", RAW_SPECIES)).drop(RAW_SPECIES)


def slim_catalog(raw: DataFrame) -> DataFrame:
    """Raw species responses (JSON text in ``value``) to catalog rows: types by slot, statistics by name."""
    doc = raw.select(F.from_json("value", SPECIES_RESPONSE).alias("d")).select("d.*")
    by_slot = F.array_sort(F.transform("types", lambda t: F.struct(t["slot"].alias("slot"), t["type"]["name"].alias("name"))))
    stats = F.map_from_entries(F.transform("stats", lambda s: F.struct(s["stat"]["name"], s["base_stat"])))
    return doc.select(
        F.col("id").alias("species_id"), "name", F.transform(by_slot, lambda t: t["name"]).alias("types"),
        "height", "weight", "base_experience", stats.alias("_stats"),
    ).select(
        "species_id", "name", "types", "height", "weight", "base_experience",
        F.struct(*[F.try_element_at("_stats", F.lit(n.replace("_", "-"))).alias(n) for n in STAT_NAMES]).alias("stats"),
    )


def catalog_side(catalog: DataFrame) -> DataFrame:
    """The catalog as a broadcast side: one row per species id, and ids outside 1..151 cannot match a sighting."""
    return F.broadcast(catalog.filter(F.col("species_id").between(MIN_SPECIES, MAX_SPECIES)))


def join_catalog(df: DataFrame, catalog: DataFrame, how: str = "inner") -> DataFrame:
    return df.join(catalog_side(catalog.select("species_id", "name", "types")), "species_id", how)


def enrich(df: DataFrame, catalog: DataFrame) -> DataFrame:
    """Name and types beside every row; a species without a catalog entry keeps its row."""
    return join_catalog(df, catalog, "left")


def missing_species(df: DataFrame, catalog: DataFrame) -> DataFrame:
    """Catalog species that no sighting has."""
    seen = df.select("species_id").distinct()
    return catalog.select("species_id", "name", "types").join(seen, "species_id", "left_anti")


def type_vocabulary(catalog: DataFrame) -> DataFrame:
    return catalog.select(F.explode("types").alias("type")).distinct()


def type_flag(catalog: DataFrame, type_name: str) -> DataFrame:
    """``species_id, has_type`` for a membership column."""
    return catalog.select("species_id", F.array_contains("types", type_name).alias("has_type"))


def species_ids(catalog: DataFrame, species_id: int | None = None, type_name: str | None = None) -> list[int] | None:
    """Ids allowed by a species and a type filter together: None means every species, an empty list none.

    A blank type is no filter, and a species must be in range. The list has at most 151 ids; as constants it reaches the Parquet scan.
    """
    if species_id is not None and (isinstance(species_id, bool) or not isinstance(species_id, int)
                                   or not MIN_SPECIES <= species_id <= MAX_SPECIES):
        raise ValueError(f"species must be an integer from {MIN_SPECIES} to {MAX_SPECIES}")
    wanted = (type_name or "").strip().lower()
    if not wanted:
        return None if species_id is None else [species_id]
    rows = catalog.filter(F.col("species_id").between(MIN_SPECIES, MAX_SPECIES)) \
        .select("species_id", F.array_contains("types", wanted).alias("match")).collect()
    ids = sorted(r["species_id"] for r in rows if r["match"])
    if not ids:
        raise ValueError(f"no species has the type {wanted!r}")
    return ids if species_id is None else [i for i in ids if i == species_id]


def species_filter(df: DataFrame, catalog: DataFrame, species_id: int | None = None,
                   type_name: str | None = None) -> DataFrame:
    ids = species_ids(catalog, species_id, type_name)
    if ids is None:
        return df
    clause: Column = F.col("species_id").isin(ids) if ids else F.lit(False)
    return df.filter(clause)
