"""Sightings, catalog, raw lines and requests derived from the given tables. Every one covers its whole table.

Sightings and catalog are Parquet and the raw lines are text, as the engine meets them in use: Spark writes each once per
session and data folder to the shared folder, and the queries read them from there.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roamgrid.functions.times import local_columns, local_date
from roamgrid.plans.aggregate import aggregate
from roamgrid.session import spread, use_utc, work_path
from roamgrid.sources.store import load_sightings, write_clean, write_clustered

LINES_PER_FILE = 4096
SIGHTINGS = """id string, species_id int, source string, lng double, lat double, appeared_utc timestamp, file string,
    line long, appeared_local timestamp, local_hour int, local_dow int, local_date string"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


_LNG = """CASE WHEN user_id % 10 = 0 THEN 2.25D ELSE -74.0D END + CAST(user_id * 37 % 256 AS DOUBLE) / 1024
          + CASE WHEN event_id % 7 = 0 THEN CAST(event_id % 1024 AS DOUBLE) / 65536 ELSE 0D END"""
_LAT = "CASE WHEN user_id % 10 = 0 THEN 48.75D ELSE 40.5D END + CAST(user_id * 91 % 251 AS DOUBLE) / 1024"
_SPECIES = "CAST((user_id * 31 + event_id % 5) % 145 + 1 AS INT)"


_written: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """Path of a derived table, written on first use in this session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = work_path(spark, name)
        write(path)
        _written[key] = path
    return _written[key]


def sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clustered table of sightings; ``file, line`` give the file order."""
    use_utc(spark)
    # One file per core or shuffle partition, whichever is more.
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    path = _once(spark, sf_dir, "sightings", lambda p: write_clustered(placed_events(spark, sf_dir), p, parts=parts))
    return spark.read.schema(SIGHTINGS).parquet(path)


def placed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events placed on dyadic coordinates."""
    rows = table(spark, sf_dir, "events").selectExpr(
        "CAST(event_id AS STRING) AS id", f"{_SPECIES} AS species_id", "event_type AS source",
        f"{_LNG} AS lng", f"{_LAT} AS lat", "CAST(ts AS TIMESTAMP) AS appeared_utc",
        "'events' AS file", "event_id AS line")
    timed = rows.withColumns(local_columns(F.col("appeared_utc"), F.col("lng")))
    return timed.withColumn("local_date", local_date(F.col("appeared_local")))


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _once(spark, sf_dir, "catalog", lambda p: part_species(spark, sf_dir).write.parquet(p))
    return use_utc(spark).read.schema("species_id int, name string, types array<string>").parquet(path)


def aggregates(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the aggregate tables, as the job writes them."""
    def write(path: str) -> None:
        aggregate(sightings(spark, sf_dir), catalog(spark, sf_dir), path)

    return _once(spark, sf_dir, "aggregates", write)


def documents(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the document table with all sightings, as the load writes it."""
    def write(path: str) -> None:
        clean = work_path(spark, "clean")
        write_clean(sightings(spark, sf_dir), clean)
        load_sightings(spark, clean, path)

    return _once(spark, sf_dir, "documents", write)


def part_species(spark: SparkSession, sf_dir: str) -> DataFrame:
    """151 species: each takes its name and types from its first part."""
    parts = table(spark, sf_dir, "part").selectExpr("CAST(p_partkey % 151 + 1 AS INT) AS species_id", "*")
    first = parts.groupBy("species_id").agg(
        F.min_by(F.struct("p_name", "p_type", "p_brand", "p_size", "p_partkey"), "p_partkey").alias("p"))
    return first.selectExpr(
        "species_id", "p.p_name AS name",
        "CASE WHEN p.p_partkey % 2 = 0 THEN array(lower(p.p_type)) ELSE array(lower(p.p_type), lower(p.p_brand)) END"
        " AS types")


def species_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw response document per part, in the shape of the species service: ``value``."""
    return table(spark, sf_dir, "part").selectExpr("""concat(
        '{"id":', p_partkey, ',"name":"', p_name, '","height":', p_size, ',"weight":', p_size * 2, ',"order":1',
        CASE WHEN p_partkey % 5 = 0 THEN '' ELSE concat(',"base_experience":', p_partkey % 300) END,
        ',"types":[', CASE WHEN p_partkey % 2 = 0 THEN '' ELSE
            concat('{"slot":2,"type":{"name":"', lower(p_brand), '"}},') END,
        '{"slot":1,"type":{"name":"', lower(p_type), '"}}]',
        ',"stats":[{"base_stat":', p_partkey % 90, ',"stat":{"name":"speed"}},{"base_stat":', p_size,
        ',"stat":{"name":"hp"}},{"base_stat":', p_partkey % 70, ',"stat":{"name":"special-attack"}}]}') AS value""")


# ---- raw lines ------------------------------------------------------------------------------------------------------
# Faults are planted by the event number; a later stage of the cleaning rules hits whatever an earlier one let through.

_RAW_PARTS = {
    "oid": "concat(CASE WHEN copy = 1 AND event_id % 40 <> 0 THEN 'c' ELSE '0' END, lpad(lower(hex(event_id)), 23, '0'))",
    "species_json": """CASE
        WHEN event_id % 41 = 5 THEN ''
        WHEN event_id % 43 = 6 THEN concat(',"pokemonId":', CASE WHEN event_id % 2 = 0 THEN 0 ELSE 152 END)
        WHEN event_id % 47 = 8 THEN concat(',"pokemonId":"', species_id, '"')
        WHEN event_id % 53 = 9 THEN concat(',"pokemonId":', species_id, CASE WHEN copy = 1 THEN '' ELSE '.0' END)
        WHEN event_id % 59 = 10 THEN concat(',"pokemonId":', CASE WHEN copy = 1 THEN '1' ELSE 'true' END)
        ELSE concat(',"pokemonId":', species_id) END""",
    "source_json": """CASE WHEN event_id % 71 = 3 THEN '' ELSE concat(',"source":"', source, '"') END""",
    "date_json": """CASE WHEN event_id % 31 <> 2 THEN concat('{"$date":"', date_text, '"}')
        ELSE element_at(array('{"$date":"no-date"}', '{}', 'null', '12345', '{"$date":"12:00:00"}',
                              concat('{"$date":"', substring(date_text, 1, 19), ' Europe/Madrid"}')),
                        CAST(event_id div 31 % 6 AS INT) + 1) END""",
    "time_json": """CASE WHEN event_id % 61 = 1 THEN '' ELSE concat(',"localTime":"', date_format(
        appeared_local + CASE WHEN event_id % 67 = 2 THEN interval 7 minutes ELSE interval 0 minutes END, 'HH:mm:ss'),
        '"') END""",
    # The rule a place can break is chosen by the event number, and the breaking value is made from it and the true place.
    "place_json": """CASE WHEN event_id % 37 <> 4 THEN concat(',"location":{"type":"Point","coordinates":[', lng, ',', lat, ']}')
        WHEN event_id div 37 % 10 = 0 THEN ''
        ELSE concat(',"location":{"type":"', CASE WHEN event_id div 37 % 10 = 7 THEN 'LineString' ELSE 'Point' END, '","coordinates":[',
            CASE event_id div 37 % 10 WHEN 1 THEN '0' WHEN 2 THEN CAST(181 + event_id % 100 AS STRING) WHEN 4 THEN 'null'
                WHEN 5 THEN concat('"', lng, '"') ELSE CAST(lng AS STRING) END,
            CASE event_id div 37 % 10 WHEN 1 THEN ',0' WHEN 3 THEN concat(',', -91 - event_id % 50) WHEN 6 THEN ''
                WHEN 8 THEN ',NaN' WHEN 9 THEN ',false' ELSE concat(',', lat) END, ']}') END""",
}

_RAW_LINE = """CASE
    WHEN event_id % 100 = 57 THEN '  \\t'
    WHEN event_id % 50 = 7 THEN ''
    WHEN event_id % 29 = 3 THEN element_at(array(substring(whole, 1, length(whole) - 9), replace(whole, '"', "'"),
                                                 '[1]', '5', concat(whole, ' xyz'), concat(whole, '{"a":"}"}')),
                                           CAST(event_id div 29 % 6 AS INT) + 1)
    ELSE whole END"""


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part, event_id, copy, value``: one JSON line per event, two for every twentieth."""
    base = placed_events(spark, sf_dir).selectExpr(
        "line AS event_id", "species_id", "source", "lng", "lat", "appeared_utc", "appeared_local",
        "explode(CASE WHEN line % 20 = 0 THEN array(0, 1) ELSE array(0) END) AS copy")
    # Forms of the date: an offset, and for some of the dates that are none of the bad ones, basic, week and short-offset forms.
    dated = base.selectExpr("*", """CASE WHEN event_id % 79 = 6 AND event_id % 31 <> 2 THEN element_at(array(
            date_format(appeared_utc, "yyyyMMdd'T'HHmmss.SSS'Z'"),
            concat(extract(YEAROFWEEK FROM appeared_utc), '-W', lpad(CAST(weekofyear(appeared_utc) AS STRING), 2, '0'), '-',
                weekday(appeared_utc) + 1, date_format(appeared_utc, "'T'HH:mm:ss.SSS'Z'")),
            concat(date_format(appeared_utc + interval 2 hours, "yyyy-MM-dd'T'HH:mm:ss,SSS"), '+0200')), CAST(event_id div 79 % 3 AS INT) + 1)
        WHEN event_id % 73 = 4
        THEN concat(date_format(appeared_utc + interval 2 hours, "yyyy-MM-dd'T'HH:mm:ss.SSS"), '+02:00')
        ELSE date_format(appeared_utc, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'") END AS date_text""")
    pieces = dated.selectExpr("event_id", "copy", *[f"{e} AS {n}" for n, e in _RAW_PARTS.items()])
    whole = pieces.selectExpr("event_id", "copy", """concat('{"_id":{"$oid":"', oid, '"}', species_json, source_json,
        ',"appearedOn":', date_json, time_json, place_json, ',"__v":0}') AS whole""")
    part = f"concat('part', lpad(CAST(event_id div {LINES_PER_FILE} AS STRING), 6, '0'))"
    return whole.selectExpr(f"{part} AS part", "event_id", "copy", f"{_RAW_LINE} AS value")


def raw_glob(spark: SparkSession, sf_dir: str) -> str:
    """Glob of the raw lines as text files."""
    def write(path: str) -> None:
        lines = raw_lines(spark, sf_dir).repartition("part").sortWithinPartitions("part", "event_id", "copy")
        lines.select("part", "value").write.partitionBy("part").text(path)

    return f"{_once(spark, sf_dir, 'raw', write)}/*/*.txt"


def part_of(file: str = "file"):
    """Name of the pseudo-file in a path."""
    return F.regexp_extract(file, r"part=(part\d+)", 1)


# ---- requests -------------------------------------------------------------------------------------------------------

def point_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text request per customer, with faults planted by the customer number."""
    k = "c_custkey"
    good = spread(table(spark, sf_dir, "customer")).selectExpr(
        f"{k} AS k",
        f"CASE WHEN {k} % 10 = 0 THEN 2.25D ELSE -74.0D END + CAST({k} * 53 % 256 AS DOUBLE) / 1024 + 1 / 4096D AS lng",
        f"CASE WHEN {k} % 10 = 0 THEN 48.75D ELSE 40.5D END + CAST({k} * 29 % 251 AS DOUBLE) / 1024 + 1 / 8192D AS lat",
        f"CASE WHEN {k} % 97 = 0 THEN 25000 ELSE 100 + {k} % 40 * 25 END AS radius",
        f"CASE WHEN {k} % 3 = 0 THEN NULL ELSE CAST(1 + {k} % 60 AS STRING) END AS limit",
        f"CASE WHEN {k} % 5 = 0 THEN CAST(1 + {k} % 151 AS STRING) END AS species",
        f"CASE WHEN {k} % 7 = 0 THEN ' Economy ' WHEN {k} % 7 = 1 THEN '' END AS type")
    return good.selectExpr(
        "k AS query_id",
        """CASE k % 61 WHEN 1 THEN '' WHEN 2 THEN 'abc' WHEN 3 THEN 'nan' WHEN 4 THEN '91' WHEN 20 THEN '-inf'
            WHEN 22 THEN '91' ELSE CAST(lat AS STRING) END AS lat""",
        """CASE k % 61 WHEN 5 THEN NULL WHEN 6 THEN '181' WHEN 21 THEN '1e400' WHEN 22 THEN ''
            ELSE CAST(lng AS STRING) END AS lng""",
        """CASE k % 61 WHEN 7 THEN '0' WHEN 8 THEN '-5' WHEN 9 THEN '50001' WHEN 10 THEN '' WHEN 23 THEN '5 km'
            ELSE CAST(radius AS STRING) END AS radius""",
        """CASE k % 61 WHEN 15 THEN '0' WHEN 16 THEN '-1' WHEN 17 THEN '5000' WHEN 18 THEN '1.5' WHEN 19 THEN 'x' WHEN 24 THEN '2500'
            ELSE limit END AS limit""",
        "CASE k % 61 WHEN 11 THEN '0' WHEN 12 THEN '152' WHEN 13 THEN 'x' ELSE species END AS species",
        "CASE k % 61 WHEN 14 THEN 'laser' ELSE type END AS type")


# Corners of the rings by supplier number: box, arrow, box with a hole, triangle, and a bow-tie for every tenth.
_CORNERS = """CASE
    WHEN k % 10 = 9 THEN array(array(p(-h, -h), p(h, h), p(h, -h), p(-h, h), p(-h, -h)))
    WHEN k % 4 = 0 THEN array(array(p(-h, -h), p(h, -h), p(h, h), p(-h, h), p(-h, -h)))
    WHEN k % 4 = 1 THEN array(array(p(-h, -h), p(h, -h), p(0, 0), p(h, h), p(-h, h), p(-h, -h)))
    WHEN k % 4 = 2 THEN array(array(p(-h, -h), p(h, -h), p(h, h), p(-h, h), p(-h, -h)),
                              array(p(-h/2, -h/2), p(h/2, -h/2), p(h/2, h/2), p(-h/2, h/2), p(-h/2, -h/2)))
    ELSE array(array(p(-h, -h), p(h, 0), p(-h, h), p(-h, -h))) END"""


def _corners_sql() -> str:
    return re.sub(r"p\(([^,]+), ([^)]+)\)", r"concat('[', x + (\1), ',', y + (\2), ']')", _CORNERS)


def _planted(*rings: str) -> str:
    """SQL for a polygon of rings given as ``lng,lat`` expressions of a supplier's place: a hole across its shell, a spike, a ring of one
    place, and edges that cross as great circles only."""
    def position(pair: str) -> str:
        lng, lat = pair.split(",")
        return f"'[', {lng}, ',', {lat}, ']'"

    texts = ["'[', " + ", ',', ".join(map(position, ring.split())) + ", ']'" for ring in rings]
    return """concat('{"type":"Polygon","coordinates":[', """ + ", ',', ".join(texts) + ", ']}')"


# Polygons of 180 degrees and more, planted by the supplier number modulo 100, with a place that sees all their corners. The second one
# lies at 80 degrees around the place and holds the north pole.
WIDE = {26: ((0, 20), [(-100, 0), (0, -1), (100, 0), (0, 50), (-100, 0)]),
        76: ((-150, 30), [(-68.7, 5.0), (-53.6, 30.9), (-30.7, 55.6), (30.0, 70.0), (90.7, 55.6), (113.6, 30.9),
                          (128.7, 5.0), (144.9, -19.9), (169.5, -40.7), (-150.0, -50.0), (-109.5, -40.7), (-84.9, -19.9), (-68.7, 5.0)])}


def _wide(k: int) -> str:
    ring = ",".join(f"[{x},{y}]" for x, y in WIDE[k][1])
    return f"""WHEN {k} THEN '{{"type":"Polygon","coordinates":[[{ring}]]}}'"""


def polygon_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One GeoJSON request per supplier, with faults planted by the supplier number."""
    placed = spread(table(spark, sf_dir, "supplier")).selectExpr(
        "s_suppkey AS k", "-74.0D + CAST(s_suppkey * 53 % 256 AS DOUBLE) / 1024 + 1 / 2048D AS x",
        "40.5D + CAST(s_suppkey * 29 % 200 AS DOUBLE) / 1024 + 1 / 2048D AS y",
        "CAST(1 + s_suppkey % 8 AS DOUBLE) / 256 AS h")
    shaped = placed.selectExpr("k", "x", "y", "h", f"{_corners_sql()} AS corners")
    rings = shaped.selectExpr(
        "k", "x", "y", "h", "concat('[', array_join(transform(corners, r -> concat('[', array_join(r, ','), ']')), ','), ']') AS rings")
    polygon = rings.selectExpr(
        "k", "x", "y", "h", """CASE WHEN k % 3 = 0 THEN concat('{"type":"Feature","geometry":{"type":"Polygon","coordinates":', rings, '}}')
                ELSE concat('{"type":"Polygon","coordinates":', rings, '}') END AS body""")
    many = """concat('{"type":"Polygon","coordinates":[[', array_join(transform(sequence(0, 500),
        i -> concat('[', i / 1024D, ',', i % 7 / 1024D, ']')), ','), ',[0,0]]]}')"""
    return polygon.selectExpr("k AS polygon_id", f"""CASE k % 50
        WHEN 11 THEN 'null' WHEN 12 THEN '[1]' WHEN 13 THEN '{{"type":"Point","coordinates":[1,2]}}'
        WHEN 14 THEN '{{"type":"Polygon"}}' WHEN 15 THEN '{{"type":"Polygon","coordinates":[]}}'
        WHEN 16 THEN '{{"type":"Polygon","coordinates":[[[0,0],[1,0],[0,0]]]}}'
        WHEN 17 THEN '{{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,1]]]}}'
        WHEN 18 THEN '{{"type":"Polygon","coordinates":[[[0,0],[200,0],[1,1],[0,0]]]}}'
        WHEN 19 THEN '{{"type":"Polygon","coordinates":[[[0,0],[1,95],[1,1],[0,0]]]}}'
        WHEN 21 THEN '{{"type":"Polygon","coordinates":[[[0,0],["1",0],[1,1],[0,0]]]}}'
        WHEN 22 THEN '{{"type":"Polygon","coordinates":[[[0,0],[1,0,5],[1,1],[0,0]]]}}'
        WHEN 23 THEN {many}
        WHEN 24 THEN '{{"type":"Polygon"'
        WHEN 27 THEN {_planted("x,y x+h,y x+h,y+h x,y+h x,y", "x+h/2,y+h/2 x+2*h,y+h/2 x+h/2,y+h/4 x+h/2,y+h/2")}
        WHEN 28 THEN {_planted("x,y x+h,y x+h,y+h x+2*h,y+2*h x+h,y+h x,y+h x,y")}
        WHEN 31 THEN {_planted("x,y x,y x,y x,y")}
        WHEN 32 THEN {_planted("x-40,y+h x+40,y+h x+41,y+2 x,y+4 x-41,y+2 x-40,y+h")}
        WHEN 33 THEN '{{"type":"Polygon","coordinates":[[[10,20],[-170,-20],[50,50],[10,20]]]}}'
        WHEN 26 THEN CASE k % 100 {" ".join(map(_wide, WIDE))} END
        ELSE body END AS body""")
