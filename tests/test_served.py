"""Stored tables read by their manifests: few files, and the results of the whole table."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from roamgrid.functions.cells import curve_key
from roamgrid.operators import grid, listings, spatial, temporal
from roamgrid.sources import served, store
from roamgrid.sources.manifest import Served

CLEAN = ("id string, species_id int, source string, lng double, lat double, appeared_utc timestamp, appeared_local timestamp, "
         "local_hour int, local_dow int")


def clean_rows(spark, rows):
    return spark.createDataFrame(rows, "id string, species_id int, lng double, lat double").selectExpr(
        "id", "species_id", "'S' AS source", "lng", "lat", "TIMESTAMP'2024-01-01 00:00:00' AS appeared_utc",
        "TIMESTAMP'2024-01-01 00:00:00' AS appeared_local", "0 AS local_hour", "0 AS local_dow")


def load(spark, rows, folder, target, name, **options):
    store.write_clean(clean_rows(spark, rows), f"{folder}/{name}")
    return store.load_sightings(spark, f"{folder}/{name}", target, **options).filter("input_file is null").first()


def crowd(n, seed=1):
    """A third of the rows at one point, the rest over the globe."""
    rng = random.Random(seed)
    return [(f"{i:06d}", i % 150 + 1, *((2.25, 48.75) if i % 3 == 0 else (rng.uniform(-180, 180), rng.uniform(-80, 80)))) for i in range(n)]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("served")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    load(spark, crowd(6000), folder, f"{folder}/documents", "clean")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    return f"{folder}/documents"


def test_curve_is_interleaved_bits(spark):
    rows = [(-180.0, -90.0), (180.0, 90.0), (0.0, 0.0), (12.5, -33.25), (-180.0, 90.0)]
    for r in spark.createDataFrame(rows, "lng double, lat double").withColumn("k", curve_key()).collect():
        x, y = (min(int((v + h) / (2 * h) * 2**20), 2**20 - 1) for v, h in ((r["lng"], 180), (r["lat"], 90)))
        assert r["k"] == sum(((x >> b & 1) << 2 * b) | ((y >> b & 1) << 2 * b + 1) for b in range(20))


@pytest.mark.parametrize("lng, lat, radius", [(2.25, 48.75, 500), (2.25, 48.75, 50_000), (100.0, 10.0, 50_000), (179.9, 0.0, 50_000),
                                              (-179.9, 60.0, 50_000), (0.0, 89.9, 50_000), (0.0, -79.0, 50_000)])
def test_lookups_read_few_files_and_all_rows(spark, stored, lng, lat, radius):
    table = store.from_documents(spark.read.parquet(stored))
    documents = served.ServedDocuments(spark, stored)
    got = documents.geonear(lng, lat, radius, limit=1000)
    want = spatial.geonear(table, lng, lat, radius, limit=1000)
    assert got.collect() == want.collect() and len(documents.entries) >= 40 and not documents.unknown
    holding = table.filter(f"abs(lat - {lat}) < 2").select(F.input_file_name()).distinct().count()
    assert len(got.inputFiles()) <= max(holding, 1) + 3


def test_a_box_of_either_direction_prunes(spark, stored):
    documents = served.ServedDocuments(spark, stored)
    n = len(documents.entries)
    assert len(documents.overlapping([(100.0, -80.0, 101.0, 80.0)])) < n / 2  # few of longitude
    assert len(documents.overlapping([(-180.0, 20.0, 180.0, 21.0)])) < n / 2  # few of latitude
    assert len(documents.overlapping([(100.0, 20.0, 101.0, 21.0)])) <= 3


def test_polygons(spark, stored):
    table = store.from_documents(spark.read.parquet(stored))
    documents = served.ServedDocuments(spark, stored)
    for ring in ([(0, 45), (5, 45), (5, 50), (0, 50), (0, 45)], [(-40, 50), (40, 50), (40, 51), (-40, 51), (-40, 50)],
                 [(-40, -60), (40, -60), (0, -62), (-40, -60)]):
        got, want = documents.within([ring], limit=1000), spatial.within(table, [ring], limit=1000)
        assert got.collect() == want.collect() and len(got.inputFiles()) < len(documents.entries)
    with pytest.raises(ValueError):
        documents.within([[(0, 0), (1, 1)]])
    with pytest.raises(ValueError):
        documents.near(200, 0, 10)


def test_a_load_reads_ids_near_the_new_ones_only(spark, tmp_path):
    target = str(tmp_path / "documents")
    old = [(f"{i:06d}", 1, 1.0, 2.0) for i in range(10_000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    assert tuple(load(spark, old, tmp_path, target, "a"))[1:] == (10_000, 10_000, 0)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    late = [(f"{i:06d}", 1, 1.0, 2.0) for i in range(9_950, 10_050)]
    files = Served(spark, f"{target}/_ids").entries
    hit = store.known_ids(spark, target, clean_rows(spark, late).select("id"))
    wanted = [e for e in files if e["last"] >= "009950"]
    assert len(files) >= 2 and len(hit.inputFiles()) == len(wanted) < len(files)
    assert tuple(load(spark, late, tmp_path, target, "b"))[1:] == (100, 50, 50)
    assert tuple(load(spark, late, tmp_path, target, "b"))[1:] == (100, 0, 100)
    assert tuple(load(spark, old[:5] + late, tmp_path, target, "c"))[1:] == (105, 0, 105)
    table = spark.read.parquet(target)
    assert table.count() == table.select("_id").distinct().count() == 10_050
    assert served.ServedDocuments(spark, target).near(1.0, 2.0, 10, limit=1000).count() == 1000
    assert tuple(load(spark, late, tmp_path, target, "b", replace=True))[1:] == (100, 100, 0)
    assert sum(e["rows"] for e in served.ServedDocuments(spark, target).entries) == 100


def test_files_without_manifest_are_read_and_described_later(spark, tmp_path):
    target = str(tmp_path / "documents")
    load(spark, [("a", 1, 1.0, 2.0)], tmp_path, target, "a")
    # A load that stopped after the rows and before the index.
    store.write_clustered(store.to_documents(clean_rows(spark, [("b", 1, 1.0, 2.0)])), target, by="_id", mode="append")
    documents = served.ServedDocuments(spark, target)
    assert len(documents.unknown) == 1 and documents.near(1.0, 2.0, 10).count() == 2
    assert tuple(load(spark, [("a", 1, 1.0, 2.0), ("b", 1, 1.0, 2.0), ("c", 1, 1.0, 2.0)], tmp_path, target, "b"))[1:] == (3, 1, 2)
    assert not served.ServedDocuments(spark, target).unknown


def test_stored_aggregates(spark, stored, tmp_path):
    rows = store.from_documents(spark.read.parquet(stored))
    whole = grid.agg_grid(rows, 5.0).cache()
    path = str(tmp_path / "agg_grid")
    served.write_grid(whole, path, parts=24)
    table = served.ServedGrid(spark, path)
    for limit, box in ((1, {}), (10, {}), (500, {}), (20, {"min_lat": 0.0}), (5, {"min_lng": -10.0, "max_lng": 10.0}), (3, {"min_lat": 85.0})):
        assert table.list_grid(limit, **box).collect() == listings.list_grid(whole, limit, **box).collect()
        assert table.heat(limit, **box).collect() == listings.heat(whole, limit, **box).collect()
    assert len(table.top_files(1)) < len(table.entries) / 3 and len(table.top_files(500, min_lat=70.0)) < len(table.entries)
    plan = plan_of(table.list_grid(5, min_lat=1.0))
    assert "GreaterThanOrEqual(lat_c" in plan
    with pytest.raises(ValueError):
        table.list_grid(501)

    time = temporal.agg_time(rows)
    served.write_time(time, str(tmp_path / "agg_time"))
    back = store.read_table(spark, str(tmp_path), "agg_time")
    hours = listings.list_time(back, "hour")
    assert "PartitionFilters: [isnotnull(granularity" in plan_of(hours) and len(hours.inputFiles()) >= 1
    assert hours.select(*time.columns).collect() == listings.list_time(time, "hour").collect()
