"""Cleaning rules, line by line."""

import json

import pytest
from pyspark.sql import functions as F

from roamgrid.operators import cleaning, profile
from roamgrid.sources import raw as raw_source

# Made for these tests: a whole record, and one rule broken at a time.
BASE = {
    "__v": 3, "_id": {"$oid": "00000000000000000000beef"}, "pokemonId": 77, "source": "SCAN", "localTime": "23:10:05",
    "appearedOn": {"$date": "2021-02-03T04:05:06.250Z"}, "location": {"type": "Point", "coordinates": [12.5, -33.25]},
}


def line(**over) -> str:
    return json.dumps({k: v for k, v in {**BASE, **over}.items() if v != "ABSENT"})


def at(*coordinates, kind="Point"):
    return {"location": {"type": kind, "coordinates": list(coordinates)}}


def dated(text):
    return {"appearedOn": {"$date": text}}


BROKEN = {
    "coordinates": [
        *[at(*pair) for pair in ((0, 0.0), (180.5, 1), (-181, 1), (1, 90.01), (1, -97), (None, None), ("12.5", "1"), (True, 5),
                                 (3, float("nan")), (), (4,), (4, 5, 6))],
        at(4, 5, kind="MultiPoint"), {"location": "ABSENT"}, {"location": "here"}, {"location": {"type": "Point"}},
        {**at(0, 0), "pokemonId": -1}],
    "species": [{"pokemonId": x} for x in ("ABSENT", None, -3, 0, 152, 1e9, 77.0, 77.5, "77", "", False, [77])],
    "date": [{"appearedOn": x} for x in ("ABSENT", None, {}, "2021-02-03", {"$date": None}, {"$date": 1612325106})] + [
        dated(x) for x in ("soon", "04:05:06", "2021", "2021-02-30", "2021-02-03T25:00:00", "2021-2-3", "2021-02-03T4:05:06",
                           "2021-02-03T04:05:06 Europe/Madrid", "2021-02-03T04:05:06Z ", " 2021-02-03T04:05:06Z")],
    "ok": [
        {}, {"source": "ABSENT"}, {"localTime": 5}, {"more": [1, {"a": 2}]}, at(-180, 90), at(180, -90), at(0, 1), at(5, 0),
        {"pokemonId": 1}, {"pokemonId": 151}, *[dated(x) for x in (
            "2021-02-03", "2021-02-03 04:05:06", "2021-02-03T04:05:06", "2021-02-03T04:05:06.123456Z", "2021-02-03T04:05:06+05:30")]],
}
DEEP = {"a": {}}
for _ in range(12):
    DEEP = {"b": DEEP, "}": ["{"]}
CASES = [(reason, line(**change)) for reason, changes in BROKEN.items() for change in changes] + [
    ("ok", "\t" + line() + "  \r"), ("invalid", "{" + line()), ("invalid", line()[1:]), ("invalid", '"text"'), ("invalid", "[]"),
    ("invalid", "17"), ("blank", ""), ("blank", "\t \r"),
    # Text after the object, whatever it looks like; braces in strings are no braces.
    *[("invalid", line() + x) for x in (" xyz", "{}", "}", "]", "] x}", "} x}", ",{}", "\\", "{", ' {"a":"}"}')],
    ("ok", line(more="} {")), ("ok", line(more='\\"} {')), ("ok", line(more=DEEP)),
    ("invalid", line(more=DEEP) + "{}"),
]


def rows_of(spark, lines):
    rows = [("f", 0, i, v) for i, v in enumerate(lines)]
    return spark.createDataFrame(rows, "file string, block long, seq long, value string")


def test_reasons(spark):
    judged = cleaning.judged(rows_of(spark, [v for _, v in CASES])).orderBy("seq").collect()
    got = [(r["reason"] or "ok", CASES[r["seq"]][1]) for r in judged]
    assert got == [(reason, value) for reason, value in CASES]


def test_clean_row(spark):
    row = cleaning.clean_rows(cleaning.judged(rows_of(spark, [line()]))).first()
    assert (row["id"], row["species_id"], row["source"]) == (BASE["_id"]["$oid"], 77, "SCAN")
    assert (row["lng"], row["lat"]) == (12.5, -33.25)
    assert str(row["appeared_utc"]) == "2021-02-03 04:05:06.250000"
    assert str(row["appeared_local"]) == "2021-02-03 04:55:06.250000"  # 50 minutes: solar, not the clock of the record
    assert (row["local_hour"], row["local_dow"]) == (4, 2)


@pytest.mark.parametrize("text, lng, local", [
    ("2016-09-21T01:00:00Z", -90.0, "2016-09-20 19:00:00"),
    ("2016-09-21T01:00:00Z", 0.125, "2016-09-21 01:00:00"),   # half a minute rounds to the even 0
    ("2016-09-21T01:00:00Z", 0.375, "2016-09-21 01:02:00"),   # 1.5 rounds to 2
    ("2016-09-21T01:00:00+02:00", 10.0, "2016-09-20 23:40:00"),
])
def test_local_time(spark, text, lng, local):
    raw = rows_of(spark, [line(appearedOn={"$date": text}, **at(lng, 1.0))])
    assert str(cleaning.clean_rows(cleaning.judged(raw)).first()["appeared_local"]) == local


def test_missing_source_is_text(spark):
    assert cleaning.clean_rows(cleaning.judged(rows_of(spark, [line(source=None)]))).first()["source"] == "None"


def test_dedup_keeps_first_and_report_adds_up(spark):
    lines = [line(_id={"$oid": o}) for o in "abc"] + [line(_id={"$oid": "d"}, pokemonId=1), line(pokemonId=0), "{", ""]
    judged = cleaning.judged(rows_of(spark, lines))
    kept = cleaning.dedup(cleaning.clean_rows(judged)).orderBy("id").collect()
    assert [r["id"] for r in kept] == ["a", "d"]
    report = cleaning.clean_report(judged).first().asDict()
    assert report == {"lines_read": 6, "invalid_json": 1, "bad_coordinates": 0, "bad_species": 1, "bad_date": 0,
                      "after_rules": 4, "final_rows": 2, "duplicates": 2}


CATEGORIES = [
    ("sin_location", line(location="ABSENT")), ("sin_location", line(location=5)),
    ("tipo_no_point", line(**at(1, 2, kind="Polygon"))), ("tipo_no_point", line(location={"coordinates": [1, 2]})),
    ("coordinates_malformado", line(**at(1))), ("coordinates_malformado", line(location={"type": "Point"})),
    ("coordinates_malformado", line(location={"type": "Point", "coordinates": "x"})),
    ("no_numerico_o_nulo", line(**at(None, 10))), ("no_numerico_o_nulo", line(**at("a", 10))),
    ("no_numerico_o_nulo", line(**at(True, 10))), ("nan", line(**at(float("nan"), 10))),
    ("fuera_de_rango", line(**at(200, 10))), ("cero_cero", line(**at(0, 0))), ("ok", line()),
]


def test_coordinate_categories(spark):
    rows = profile.profile_rows(rows_of(spark, [v for _, v in CATEGORIES])).orderBy("seq").collect()
    assert [r["category"] for r in rows] == [c for c, _ in CATEGORIES]
    assert rows[-3]["lng"] == 200.0 and rows[0]["lng"] is None


def test_events_are_equal_by_value(spark):
    """Numbers and booleans count by value, quoted numbers apart."""
    for ids, repeated in (([134, 134.0], 1), ([1, True, 1.0], 2), ([0, False], 1), ([134, "134"], 0), (["134", "134", 134.5], 1)):
        rows = profile.profile_rows(rows_of(spark, [line(pokemonId=i) for i in ids]))
        assert profile.profile_dups(rows).first()["dup_event"] == repeated, ids


def test_events_without_any_value_repeat_each_other(spark):
    bare = '{"_id":{"$oid":"%s"}}'
    rows = profile.profile_rows(rows_of(spark, [bare % "a", bare % "b", "{}", "{}"]))
    assert profile.profile_dups(rows).drop("file").first().asDict() == {"dup_id": 0, "dup_event": 3}


# ---- files ----------------------------------------------------------------------------------------------------------

@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.fixture
def files(tmp_path):
    contents = {}
    for name, n in (("a.json", 57), ("b.json", 20), ("c.json", 3)):
        lines = ["" if i % 9 == 4 else "{" if i % 11 == 5 else line(_id={"$oid": f"{name}{i:04}"}) for i in range(n)]
        (tmp_path / name).write_text("\n".join(lines) + "\n")
        contents[name] = lines
    return str(tmp_path / "*.json"), contents


def test_line_numbers_over_splits(spark, small_splits, files):
    path, contents = files
    raw = raw_source.read_raw(spark, path)
    assert raw.select("file", "block").distinct().count() > 10
    numbered = raw_source.with_line_numbers(raw).withColumn("name", F.substring_index("file", "/", -1)).collect()
    assert sorted((r["name"], r["line"], r["value"]) for r in numbered) == sorted(
        (n, i, v) for n, lines in contents.items() for i, v in enumerate(lines))


def test_other_splits_in_the_second_scan_are_an_error(spark, small_splits, files):
    path, _ = files
    splits = raw_source.split_table(raw_source.read_raw(spark, path))
    for size in ("400", "5000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        with pytest.raises(Exception, match="cut them differently"):
            raw_source.with_line_numbers(raw_source.read_raw(spark, path), splits).collect()


def test_stride_prefix_and_plan(spark, small_splits, files):
    path, contents = files
    raw = raw_source.read_raw(spark, path)
    splits = raw_source.split_table(raw)
    numbered = raw_source.with_line_numbers(raw, splits)
    taken = raw_source.stride_sample(numbered, 4)
    assert taken.count() == sum(-(-len(v) // 4) for v in contents.values())
    assert {r["line"] % 4 for r in taken.collect()} == {0}
    assert raw_source.prefix_sample(numbered, 5).count() == 13
    plan = {r["file"].rsplit("/", 1)[-1]: (r["lines"], r["lines_taken"]) for r in raw_source.scan_plan(splits, 4).collect()}
    assert plan == {"a.json": (57, 15), "b.json": (20, 5), "c.json": (3, 1)}


@pytest.mark.parametrize("n", [1, 7, 16, 40, 500])
def test_parsed_prefix(spark, small_splits, files, n):
    path, contents = files
    parsed = cleaning.parse_lines(raw_source.read_raw(spark, path))
    got = raw_source.parsed_prefix(parsed, n).select(F.col("doc._id.$oid").alias("id")).collect()
    wanted = [json.loads(v)["_id"]["$oid"] for lines in contents.values() for v in [x for x in lines if len(x) > 1][:n]]
    assert sorted(r["id"] for r in got) == sorted(wanted)


# Every form is compared with the standard library's reading of it.
ISO_FORMS = """20210203 2021-W05 2021W05 2021-W05-3 2021W053 2021-W54-1 2021-W53-1 2020-W53-1 2020-W53-7 2021-W00-1 2021-W05-0 2021-W05-8 20210203T0405
2021-02-03T04 2021-02-03T04:05 2021-02-03x04:05:06 2021-02-03T040506 2021-02-03T0405:06 20210203T04:05:06. 2021-02-03T04:05:06,5 2021-02-03é04:05
2021-02-03T04:05:06.1234567891 2021-02-03T04:05:06+02 2021-02-03T04:05:06+0200 2021-02-03T04:05:06+02:99 2021-02-03T04:05:06+23:59
2021-02-03T04:05:06-23:59 2021-02-03T04:05:06+24:00 2021-02-03T04:05:06+02:00:30 2021-02-03T04:05:06-02:00:30.5 2021-02-03T04:05:06+020030
2021-02-03T24:00 2021-02-03T04:60 2021-02-03T04:05:60 2021-02-03T04:05+0200 2021-02-03T 20210203040506 2021-02-03+02:00 202102030405 2021-02-03Z
2021-W05T04 2021W05T04:05 2021-W05-3T04:05Z 2021-0203 2021-W053 0000-01-01 0001-01-02 2021-02-03T04:05:06-00:00 2021-02-03T04.5 2021-034
2021-02-03TT04:05 2021W0504:05 2021-W05-04:05 2021-W05-31 20210203T040506.25+05 2021-02-03T04:05:06ZZ 20210230 20211301T00 99991231T235959 2021-02-03T4
2021-02-03T04:05:06+02:0030 2021-02-03T04:05:06+18:30 20210203T040506Z 2009-W01-1 2008-W52-7 2010-W53-6 2019-W01 |2021 2021||02""".split()


def test_iso_forms(spark):
    from datetime import datetime, timezone

    from roamgrid.functions.times import iso_z, parse_utc

    def read(text):
        try:
            found = datetime.fromisoformat(text.replace("Z", "+00:00"))
        except ValueError:
            return None
        found = found.astimezone(timezone.utc).replace(tzinfo=None) if found.tzinfo else found
        return f"{found.year:04d}" + found.isoformat()[4:] + "Z"

    rows = spark.createDataFrame([(x,) for x in ISO_FORMS], "t string").withColumn("z", iso_z(parse_utc(F.col("t")))).collect()
    assert {r["t"]: r["z"] for r in rows} == {x: read(x) for x in ISO_FORMS}
