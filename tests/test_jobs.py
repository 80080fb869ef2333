"""Whole jobs: raw files to the clean table, loading, aggregate tables."""

import json

import pytest

from roamgrid.operators import listings, temporal
from roamgrid.plans.aggregate import aggregate
from roamgrid.plans.ingest import ingest
from roamgrid.plans.profile import profile_quality, profile_spots
from roamgrid.sources import catalog as cat
from roamgrid.sources import store
from roamgrid.sources.raw import read_raw


def document(i: int, **over) -> str:
    base = {"_id": {"$oid": f"{i:024x}"}, "pokemonId": 1 + i % 3, "source": "X",
            "appearedOn": {"$date": f"2016-09-{1 + i % 20:02}T12:26:25.000Z"}, "localTime": "07:26:25",
            "location": {"type": "Point", "coordinates": [-73.0 - i / 1e4, 40.0]}, "__v": 0}
    return json.dumps({**base, **over})


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    lines = [document(i) for i in range(40)]
    (folder / "part1.json").write_text("\n".join(lines[:20]) + "\n")
    bad = ["", "{", document(90, pokemonId=0), document(91, location=None), document(92, appearedOn=None),
           document(93, **{k: v for k, v in json.loads(document(7)).items() if k != "_id"})]
    (folder / "part2.json").write_text("\n".join(lines[20:] + bad) + "\n")
    return str(folder / "*.json")


def test_ingest_everything(spark, raw, tmp_path):
    report = ingest(spark, raw, str(tmp_path), stride=1).first().asDict()
    assert report == {"lines_read": 45, "invalid_json": 1, "bad_coordinates": 1, "bad_species": 1, "bad_date": 1,
                      "after_rules": 41, "final_rows": 40, "duplicates": 1, "stride": 1}
    table = store.read_clean(spark, f"{tmp_path}/sightings")
    assert table.count() == 40 and table.filter("id like '%5d'").count() == 0
    assert [f.name for f in table.schema] == ["id", "species_id", "source", "lng", "lat", "appeared_utc",
                                              "appeared_local", "local_hour", "local_dow"]


def test_ingest_every_fourth_line_of_each_file(spark, raw, tmp_path):
    ingest(spark, raw, str(tmp_path), stride=4, parts=2)
    ids = sorted(int(r["id"], 16) for r in store.read_clean(spark, f"{tmp_path}/sightings", ["id"]).collect())
    assert ids == [i for i in range(40) if i % 4 == 0]
    plan = spark.read.json(f"{tmp_path}/scan_plan").collect()
    assert sorted((r["lines"], r["lines_taken"]) for r in plan) == [(20, 5), (26, 7)]


def test_load_is_idempotent(spark, raw, tmp_path):
    ingest(spark, raw, str(tmp_path), stride=1, parts=3)
    clean, target = f"{tmp_path}/sightings", f"{tmp_path}/documents"
    first = store.load_sightings(spark, clean, target).collect()
    assert sum(r["rows"] for r in first if r["input_file"]) == 40 and len(first) == 4
    assert [tuple(r)[1:] for r in first if r["input_file"] is None] == [(40, 40, 0)]
    again = store.load_sightings(spark, clean, target).filter("input_file is null").first()
    assert tuple(again)[1:] == (40, 0, 40)
    replaced = store.load_sightings(spark, clean, target, replace=True).filter("input_file is null").first()
    assert tuple(replaced)[1:] == (40, 40, 0)
    documents = spark.read.parquet(target)
    assert documents.count() == 40
    assert set(documents.columns) == {"_id", "species_id", "source", "location", "lng", "lat", "appeared_utc", "local_date",
                                      "local_hour", "local_dow"}
    row = documents.filter("_id = '000000000000000000000000'").first()
    assert row["location"].asDict() == {"type": "Point", "coordinates": [-73.0, 40.0]}


def test_aggregate_tables(spark, raw, tmp_path):
    ingest(spark, raw, str(tmp_path), stride=1)
    store.load_sightings(spark, f"{tmp_path}/sightings", f"{tmp_path}/documents")
    sightings = store.from_documents(spark.read.parquet(f"{tmp_path}/documents"))
    (tmp_path / "catalog.json").write_text(json.dumps([
        {"species_id" if i % 2 else "pokemonId": i, "name": f"n{i}", "types": t, "height": 1, "weight": 2, "stats": {"hp": 3}}
        for i, t in ((1, ["a"]), (2, ["a", "b"]), (3, ["c"]), (4, ["d"]))]))
    catalog = cat.read_catalog(spark, str(tmp_path / "catalog.json"))
    tables = aggregate(sightings, catalog, str(tmp_path / "agg"))
    assert {n: t.columns[0] for n, t in tables.items()} == dict.fromkeys(
        ["agg_grid", "agg_hotspots", "agg_time", "agg_species_hour", "agg_species", "agg_type"], "_id")
    species = {r["species_id"]: r["count"] for r in tables["agg_species"].collect()}
    assert species == {1: 14, 2: 13, 3: 13}
    assert {r["type"]: r["count"] for r in tables["agg_type"].collect()} == {"a": 27, "b": 13, "c": 13}
    hours = listings.list_time(store.read_table(spark, str(tmp_path / "agg"), "agg_time")).collect()
    assert [(r["_id"], r["key"], r["count"]) for r in hours] == [("hour:07", "07", 40)]
    assert temporal.peak(tables["agg_time"].filter("granularity = 'day'"), "key").first()["key"] == "2016-09-01"
    assert [r["name"] for r in listings.list_species(tables["agg_species"], 2).collect()] == ["n1", "n2"]
    assert [r["species_id"] for r in cat.missing_species(sightings, catalog).collect()] == [4]
    with pytest.raises(ValueError):
        listings.list_species(tables["agg_species"], 152)
    with pytest.raises(ValueError):
        listings.list_time(tables["agg_time"], "week")


def test_aggregate_refuses_species_without_catalog(spark, raw, tmp_path):
    ingest(spark, raw, str(tmp_path), stride=1)
    store.load_sightings(spark, f"{tmp_path}/sightings", f"{tmp_path}/documents")
    sightings = store.from_documents(spark.read.parquet(f"{tmp_path}/documents"))
    catalog = spark.createDataFrame([(1, "n", ["a"])], "species_id int, name string, types array<string>")
    with pytest.raises(ValueError, match="add up"):
        aggregate(sightings, catalog, str(tmp_path / "agg"))


def test_profiles(spark, raw, tmp_path):
    lines = read_raw(spark, raw)
    quality = profile_quality(lines, str(tmp_path), sample=22, k=2)
    files = {r["file"].rsplit("/", 1)[-1]: r for r in quality["files"].collect()}
    assert (files["part2.json"]["rows"], files["part2.json"]["blank"], files["part2.json"]["invalid_json"]) == (24, 1, 1)
    assert files["part2.json"]["id_invalid"] == 1 and files["part2.json"]["no_date"] == 1
    dups = {r["file"].rsplit("/", 1)[-1]: (r["dup_id"], r["dup_event"]) for r in quality["dups"].collect()}
    assert dups == {"part1.json": (0, 0), "part2.json": (0, 1)}
    sample = {r["file"].rsplit("/", 1)[-1]: (r["rows"], r["coords_ok"]) for r in quality["sample"].collect()}
    assert sample == {"part1.json": (20, 20), "part2.json": (22, 21)}
    assert quality["top"].filter("dim = 'source'").first()["count"] == 44
    assert [r["example"] for r in quality["examples"].collect()] == ["{"]

    catalog = spark.createDataFrame([(1, "n", ["water"])], "species_id int, name string, types array<string>")
    spots = profile_spots(lines, catalog, str(tmp_path), prefix=10, stride=5)
    views = {r["view"]: r["sightings"] for r in spots["views"].collect()}
    # The document with species 0 is a sighting of the profile too; only a missing id is not.
    assert views == {"complete": 41, "prefix": 20, "stride": 8}
    assert spots["histogram"].count() == 18


def test_intermediate_tables_can_be_dropped(spark):
    from roamgrid import session

    table = session.materialize(spark.range(5), "gone")
    path = session._WRITTEN[-1]
    assert table.count() == 5 and spark.read.parquet(path).count() == 5
    kept, session._WRITTEN[:] = session._WRITTEN[:-1], [path]
    session.drop_intermediate(spark)
    session._WRITTEN[:] = kept
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
