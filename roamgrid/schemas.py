"""Table schemas and the constants of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Key names of the raw export, one JSON object per line.
RAW_ID = "_id"
RAW_SPECIES = "pokemonId"
RAW_SOURCE = "source"
RAW_DATE = "appearedOn"
RAW_LOCAL_TIME = "localTime"
RAW_LOCATION = "location"

# Species domain and request limits.
MIN_SPECIES, MAX_SPECIES = 1, 151
MAX_RADIUS_M = 50_000.0
DEFAULT_LIMIT, MAX_LIMIT = 50, 1000
MAX_VERTICES = 500
MAX_HOTSPOTS, MAX_GRID_ROWS = 200, 500

# Grid step in degrees and the Earth radius in metres used for spherical distances.
GRID_DEG = 0.01
EARTH_RADIUS_M = 6_378_100.0

# Typed view of a raw line. A value of another JSON type reads as NULL, which the cleaning rules rely on.
RAW_TYPED = T.StructType([
    T.StructField(RAW_ID, T.StructType([T.StructField("$oid", T.StringType())])),
    T.StructField(RAW_SPECIES, T.LongType()),
    T.StructField(RAW_SOURCE, T.StringType()),
    T.StructField(RAW_DATE, T.StructType([T.StructField("$date", T.StringType())])),
    T.StructField(RAW_LOCAL_TIME, T.StringType()),
    T.StructField(RAW_LOCATION, T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("coordinates", T.ArrayType(T.DoubleType())),
    ])),
    T.StructField("_corrupt", T.StringType()),
])

# The same keys as text: any JSON object parses, so a filled _corrupt means that the line itself is broken.
RAW_TEXT = T.StructType([
    T.StructField(RAW_ID, T.StringType()),
    T.StructField(RAW_SPECIES, T.StringType()),
    T.StructField(RAW_SOURCE, T.StringType()),
    T.StructField(RAW_DATE, T.StringType()),
    T.StructField(RAW_LOCAL_TIME, T.StringType()),
    T.StructField(RAW_LOCATION, T.StringType()),
    T.StructField("_corrupt", T.StringType()),
])

LOCATION_TEXT = "type string, coordinates string"

CLEAN = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("species_id", T.IntegerType()),
    T.StructField("source", T.StringType()),
    T.StructField("lng", T.DoubleType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("appeared_utc", T.TimestampType()),
    T.StructField("appeared_local", T.TimestampType()),
    T.StructField("local_hour", T.IntegerType()),
    T.StructField("local_dow", T.IntegerType()),
])

STAT_NAMES = ["hp", "attack", "defense", "special_attack", "special_defense", "speed"]

CATALOG = T.StructType([
    T.StructField("species_id", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("types", T.ArrayType(T.StringType())),
    T.StructField("height", T.IntegerType()),
    T.StructField("weight", T.IntegerType()),
    T.StructField("base_experience", T.IntegerType()),
    T.StructField("stats", T.StructType([T.StructField(n, T.IntegerType()) for n in STAT_NAMES])),
])

# Shape of one species document as the public species service answers it.
SPECIES_RESPONSE = """
    id int, name string, height int, weight int, base_experience int,
    types array<struct<slot: int, type: struct<name: string>>>,
    stats array<struct<base_stat: int, stat: struct<name: string>>>
"""
