"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame with plainly comparable columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roamgrid.functions.cells import cell_polygon
from roamgrid.functions.times import iso_z
from roamgrid.operators import cleaning, grid, listings, profile, requests, species, spatial, spots, temporal
from roamgrid.session import materialize, work_path
from roamgrid.sources import catalog as cat
from roamgrid.sources import raw as raw_source
from roamgrid.sources import served, store
from workload import fixtures as fx

TYPE = "economy"
CENTER = {"lng": -73.875, "lat": 40.625}
RADIUS_M = 8000.0
POLYGON = [[(-74.0, 40.5), (-73.8, 40.52), (-73.78, 40.7), (-73.9, 40.6), (-73.99, 40.72), (-74.0, 40.5)]]
BOX = {"min_lat": 40.55, "max_lat": 40.7, "min_lng": -73.95, "max_lng": -73.8}
STRIDE, PREFIX, SAMPLE = 4, 4000, 1000

QUERIES = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


def _text(df: DataFrame, *columns: str) -> DataFrame:
    """Arrays as comma-joined text."""
    return df.withColumns({c: F.array_join(F.col(c), ",") for c in columns})


# ---- grid and hotspots ----------------------------------------------------------------------------------------------

@query
def grid_cells(spark, sf):
    return grid.agg_grid(fx.sightings(spark, sf)).drop("location")


@query
def grid_bench(spark, sf):
    return grid.grid_bench(fx.sightings(spark, sf))


@query
def grid_fingerprint(spark, sf):
    return grid.grid_fingerprint(fx.sightings(spark, sf))


@query
def hotspots(spark, sf):
    return grid.hotspots(fx.sightings(spark, sf), fx.catalog(spark, sf)).drop("location", "top_species")


@query
def hotspot_species(spark, sf):
    hot = grid.hotspots(fx.sightings(spark, sf), fx.catalog(spark, sf))
    rows = hot.select("rank", F.posexplode("top_species").alias("pos", "s"))
    return _text(rows.select("rank", "pos", "s.species_id", "s.name", "s.types", "s.count"), "types")


@query
def cell_polygons(spark, sf):
    cells = grid.agg_grid(fx.sightings(spark, sf))
    return cells.select("cell_id", F.posexplode(cell_polygon()[0]).alias("pos", "p")) \
        .select("cell_id", "pos", "p.lng", "p.lat")


@query
def recount_hotspots(spark, sf):
    rows = fx.sightings(spark, sf)
    return grid.recount_hotspots(rows, grid.top_cells(grid.agg_grid(rows)))


@query
def invariants(spark, sf):
    rows, species_table = fx.sightings(spark, sf), fx.catalog(spark, sf)
    return grid.check_invariants(rows, grid.agg_grid(rows), temporal.agg_time(rows),
                                 species.agg_species(rows, species_table))


# ---- time, species, types -------------------------------------------------------------------------------------------

@query
def time_hour(spark, sf):
    return temporal.agg_time(fx.sightings(spark, sf), "hour")


@query
def time_dow(spark, sf):
    return temporal.agg_time(fx.sightings(spark, sf), "dow")


@query
def time_day(spark, sf):
    return temporal.agg_time(fx.sightings(spark, sf), "day")


@query
def time_all(spark, sf):
    return temporal.agg_time(fx.sightings(spark, sf))


@query
def species_counts(spark, sf):
    return _text(species.agg_species(fx.sightings(spark, sf), fx.catalog(spark, sf)), "types")


@query
def species_hour(spark, sf):
    return species.agg_species_hour(fx.sightings(spark, sf))


@query
def type_counts(spark, sf):
    return species.agg_type(species.agg_species(fx.sightings(spark, sf), fx.catalog(spark, sf)))


@query
def peak_hour(spark, sf):
    return temporal.peak(temporal.agg_time(fx.sightings(spark, sf), "hour"), "key")


@query
def species_audit(spark, sf):
    return species.species_audit(_flat(spark, sf).filter(F.col("status") == "doc"))


@query
def missing_species(spark, sf):
    return _text(cat.missing_species(fx.sightings(spark, sf), fx.catalog(spark, sf)), "types")


@query
def type_vocabulary(spark, sf):
    return cat.type_vocabulary(fx.catalog(spark, sf))


# ---- listings: all of these read the stored aggregates ---------------------------------------------------------------

def _stored(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return store.read_table(spark, fx.aggregates(spark, sf), name)


def _stored_grid(spark: SparkSession, sf: str) -> served.ServedGrid:
    return served.ServedGrid(spark, f"{fx.aggregates(spark, sf)}/agg_grid")


@query
def list_hotspots(spark, sf):
    return listings.list_hotspots(_stored(spark, sf, "agg_hotspots")).select("rank", "cell_id", "count", F.size("top_species").alias("top"))


@query
def list_grid(spark, sf):
    return _stored_grid(spark, sf).list_grid().select("cell_id", "count", "species")


@query
def list_time(spark, sf):
    return listings.list_time(_stored(spark, sf, "agg_time"), "dow").select(*temporal.agg_time(fx.sightings(spark, sf)).columns)


@query
def list_types(spark, sf):
    return listings.list_types(_stored(spark, sf, "agg_type").drop("_id"))


@query
def list_species(spark, sf):
    return _text(listings.list_species(_stored(spark, sf, "agg_species").drop("_id")), "types")


@query
def list_species_hours(spark, sf):
    hours = _stored(spark, sf, "agg_species_hour")
    return listings.list_species_hours(hours, fx.catalog(spark, sf), 2)


@query
def bbox_grid(spark, sf):
    return listings.bbox_filter(_stored(spark, sf, "agg_grid"), **BOX).select("cell_id", "count", "lng_c", "lat_c")


@query
def heat(spark, sf):
    return _stored_grid(spark, sf).heat(**BOX)


@query
def share_of_max(spark, sf):
    listed = listings.list_species(_stored(spark, sf, "agg_species"), 15)
    return listings.share_of_max(listed).select("species_id", "name", "count", "pct_of_max")


@query
def enrich(spark, sf):
    """Every sighting as an output record."""
    rows = listings.shape_record(fx.sightings(spark, sf), fx.catalog(spark, sf))
    placed = rows.withColumns({"lng": F.col("location.coordinates")[0], "lat": F.col("location.coordinates")[1]})
    return _text(placed.drop("location"), "types")


# ---- spatial --------------------------------------------------------------------------------------------------------

def _record(df: DataFrame, spark: SparkSession, sf: str) -> DataFrame:
    return _text(listings.shape_record(df, fx.catalog(spark, sf)).drop("location"), "types")


@query
def near(spark, sf):
    return _record(spatial.near(fx.sightings(spark, sf), radius_m=RADIUS_M, **CENTER), spark, sf)


@query
def near_species(spark, sf):
    allowed = cat.species_ids(fx.catalog(spark, sf), type_name=TYPE)
    found = spatial.near(fx.sightings(spark, sf), radius_m=RADIUS_M, species=allowed, limit=200, **CENTER)
    return found.select("id", "species_id")


@query
def geonear(spark, sf):
    return _record(spatial.geonear(fx.sightings(spark, sf), radius_m=RADIUS_M, limit=1000, **CENTER), spark, sf)


# ---- lookups in the stored documents, which read the files that the manifest names ----------------------------------

def _documents(spark: SparkSession, sf: str) -> served.ServedDocuments:
    return served.ServedDocuments(spark, fx.documents(spark, sf))


@query
def served_near(spark, sf):
    found = _documents(spark, sf).near(radius_m=RADIUS_M, **CENTER)
    return _record(found, spark, sf)


@query
def served_geonear(spark, sf):
    found = _documents(spark, sf).geonear(radius_m=RADIUS_M, limit=1000, **CENTER)
    return found.select("id", "species_id", "lng", "lat", "distance_m")


@query
def served_within(spark, sf):
    return _documents(spark, sf).within(POLYGON, limit=100).select("id", "species_id", "lng", "lat")


def _point_queries(spark: SparkSession, sf: str) -> DataFrame:
    checked = requests.check_point_requests(fx.point_requests(spark, sf), fx.catalog(spark, sf))
    return checked.filter(F.col("reason").isNull()).drop("reason")


@query
def near_join(spark, sf):
    rows = fx.sightings(spark, sf).select("id", "species_id", "lng", "lat")
    found = spatial.near_join(rows, _point_queries(spark, sf))
    return found.select("query_id", "rank", "id", "species_id", "distance_m")


@query
def near_join_shuffled(spark, sf):
    """The same by the other physical form: nothing broadcast, and cells of 50 rows already thinned."""
    rows = fx.sightings(spark, sf).select("id", "species_id", "lng", "lat")
    found = spatial.near_join(rows, _point_queries(spark, sf), max_bytes=0, crowd_rows=50)
    return found.select("query_id", "rank", "id", "species_id", "distance_m")


@query
def within(spark, sf):
    found = spatial.within(fx.sightings(spark, sf), POLYGON, limit=100)
    return found.select("id", "species_id", "lng", "lat")


@query
def within_truncated(spark, sf):
    return spatial.within_truncated(fx.sightings(spark, sf), POLYGON, limit=100)


@query
def within_total(spark, sf):
    return spatial.within_total(fx.sightings(spark, sf), POLYGON)


def _polygons(spark: SparkSession, sf: str) -> DataFrame:
    checked = requests.reject_self_intersections(requests.check_polygons(fx.polygon_requests(spark, sf)))
    return checked.filter(F.col("reason").isNull()).select("polygon_id", "rings")


@query
def within_join(spark, sf):
    rows = fx.sightings(spark, sf).select("id", "species_id", "lng", "lat")
    found = spatial.within_join(rows, _polygons(spark, sf), 200)
    return found.select("polygon_id", "rank", "id", "species_id")


@query
def within_join_shuffled(spark, sf):
    rows = fx.sightings(spark, sf).select("id", "species_id", "lng", "lat")
    found = spatial.within_join(rows, _polygons(spark, sf), 200, max_bytes=0, crowd_rows=50)
    return found.select("polygon_id", "rank", "id", "species_id")


@query
def within_totals(spark, sf):
    return spatial.within_totals(fx.sightings(spark, sf), _polygons(spark, sf))


@query
def within_top_species(spark, sf):
    return spatial.within_top_species(fx.sightings(spark, sf), POLYGON, 5)


@query
def species_filter_type(spark, sf):
    found = cat.species_filter(fx.sightings(spark, sf), fx.catalog(spark, sf), type_name=TYPE)
    return found.groupBy("species_id").agg(F.count(F.lit(1)).alias("count"))


@query
def species_filter_both(spark, sf):
    found = cat.species_filter(fx.sightings(spark, sf), fx.catalog(spark, sf), species_id=2, type_name=TYPE)
    return found.groupBy("species_id", "source").agg(F.count(F.lit(1)).alias("count"))


# ---- cleaning -------------------------------------------------------------------------------------------------------

def _raw(spark: SparkSession, sf: str) -> DataFrame:
    return raw_source.read_raw(spark, fx.raw_glob(spark, sf))


def _flat(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.flatten_raw(cleaning.parse_lines(_raw(spark, sf)))


def _clean(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_rows(cleaning.judged(_raw(spark, sf)))


def _part(df: DataFrame) -> DataFrame:
    return df.withColumn("part", fx.part_of()).drop("file")


@query
def clean_reasons(spark, sf):
    rows = _part(cleaning.judged(_raw(spark, sf)))
    return rows.groupBy("part", F.coalesce("reason", F.lit("ok")).alias("reason")).agg(F.count(F.lit(1)).alias("rows"))


@query
def clean_rows(spark, sf):
    documents = store.from_documents(store.to_documents(_clean(spark, sf)))
    return documents.withColumn("appeared_utc", iso_z(F.col("appeared_utc")))


@query
def dedup(spark, sf):
    rows = _part(cleaning.dedup(_clean(spark, sf)))
    return rows.select("part", "id", "species_id", "source", "lng", "lat", iso_z(F.col("appeared_utc")).alias("appeared_utc"))


@query
def clean_report(spark, sf):
    return cleaning.clean_report(cleaning.judged(_raw(spark, sf)))


@query
def local_time(spark, sf):
    return fx.sightings(spark, sf).select(
        "id", iso_z(F.col("appeared_local")).alias("appeared_local"), "local_hour", "local_dow", "local_date")


def _outcome(numbered: DataFrame) -> DataFrame:
    rows = _part(cleaning.judged(numbered))
    return rows.select("part", "line", "id", F.coalesce("reason", F.lit("ok")).alias("reason"))


@query
def line_numbers(spark, sf):
    return _outcome(raw_source.with_line_numbers(_raw(spark, sf)))


@query
def stride_sample(spark, sf):
    return _outcome(raw_source.stride_sample(raw_source.with_line_numbers(_raw(spark, sf)), STRIDE))


@query
def prefix_sample(spark, sf):
    return _outcome(raw_source.prefix_sample(raw_source.with_line_numbers(_raw(spark, sf)), SAMPLE))


@query
def scan_plan(spark, sf):
    return _part(raw_source.scan_plan(raw_source.split_table(_raw(spark, sf)), STRIDE))


# ---- data profile ---------------------------------------------------------------------------------------------------

def _profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.profile_rows(_raw(spark, sf))


@query
def profile_files(spark, sf):
    return _part(profile.profile_files(_profile(spark, sf)))


@query
def profile_freq(spark, sf):
    return _part(profile.profile_freq(_profile(spark, sf)))


@query
def top_k_freq(spark, sf):
    return profile.top_k(profile.profile_freq(_profile(spark, sf)), 5)


@query
def top_k_files(spark, sf):
    return _part(profile.top_k(profile.profile_freq(_profile(spark, sf)), 3, ("file",)))


@query
def least_freq(spark, sf):
    return profile.top_k(profile.profile_freq(_profile(spark, sf)), 4, least=True)


@query
def profile_cells(spark, sf):
    return profile.cells_with_data(profile.profile_freq(_profile(spark, sf)))


@query
def profile_totals(spark, sf):
    rows = materialize(_profile(spark, sf), "profile")
    return profile.profile_totals(rows, profile.profile_sample(rows, SAMPLE))


@query
def profile_dups(spark, sf):
    return _part(profile.profile_dups(_profile(spark, sf)))


@query
def profile_sample(spark, sf):
    return _part(profile.profile_sample(materialize(_profile(spark, sf), "profile"), SAMPLE))


@query
def profile_offsets(spark, sf):
    return profile.profile_offsets(_profile(spark, sf))


@query
def bad_examples(spark, sf):
    return _part(profile.bad_examples(_profile(spark, sf)))


# ---- spots ----------------------------------------------------------------------------------------------------------

def _spots(spark: SparkSession, sf: str) -> DataFrame:
    return spots.spot_rows(fx.sightings(spark, sf))


@query
def point_stats(spark, sf):
    return spots.point_stats(_spots(spark, sf))


@query
def point_histogram(spark, sf):
    return spots.point_histogram(_spots(spark, sf))


@query
def simpson(spark, sf):
    return spots.species_simpson(_spots(spark, sf))


@query
def pair_stats(spark, sf):
    return spots.pair_stats(_spots(spark, sf))


@query
def pair_by_gap(spark, sf):
    return spots.pair_by_gap(_spots(spark, sf))


@query
def near_dups(spark, sf):
    return spots.near_dups(_spots(spark, sf))


@query
def type_persistence(spark, sf):
    return spots.type_persistence(_spots(spark, sf), fx.catalog(spark, sf), TYPE)


@query
def same_source(spark, sf):
    return spots.same_source(_spots(spark, sf))


@query
def point_mix(spark, sf):
    return spots.point_mix(_spots(spark, sf))


def _iso_range(df: DataFrame) -> DataFrame:
    return df.withColumns({c: iso_z(F.col(c)) for c in ("first_utc", "last_utc")})


@query
def view_coverage(spark, sf):
    return _iso_range(spots.view_coverage(spots.with_views(_spots(spark, sf), PREFIX, STRIDE)))


@query
def compare_views(spark, sf):
    return _iso_range(spots.compare_views(fx.sightings(spark, sf), fx.catalog(spark, sf), TYPE, PREFIX, STRIDE))


# ---- requests -------------------------------------------------------------------------------------------------------

@query
def request_checks(spark, sf):
    checked = requests.check_point_requests(fx.point_requests(spark, sf), fx.catalog(spark, sf))
    return _text(checked, "species_ids")


@query
def polygon_checks(spark, sf):
    checked = requests.check_polygons(fx.polygon_requests(spark, sf))
    return checked.select("polygon_id", "reason", F.size("rings").alias("n_rings"),
                          F.size(F.flatten("rings")).alias("n_points"))


@query
def self_intersection(spark, sf):
    checked = requests.check_polygons(fx.polygon_requests(spark, sf)).filter(F.col("reason").isNull())
    return checked.select("polygon_id", requests.self_intersects(F.col("rings")).alias("crosses"))


# ---- tables ---------------------------------------------------------------------------------------------------------

@query
def load_report(spark, sf):
    """Load the clean rows, copies of ids included, into an empty document table, then once more."""
    clean_path, target = work_path(spark, "clean"), work_path(spark, "target")
    store.write_clean(_clean(spark, sf), clean_path)
    steps = [store.load_sightings(spark, clean_path, target).withColumn("step", F.lit(s)) for s in ("first", "again")]
    both = steps[0].unionByName(steps[1])
    return both.filter(F.col("input_file").isNull()).select("step", "rows", "inserted", "duplicate_ids")


@query
def near_documents(spark, sf):
    """A search of the table that the load writes: only the files near the point are read."""
    clean_path, target = work_path(spark, "clean"), work_path(spark, "target")
    store.write_clean(_clean(spark, sf), clean_path)
    store.load_sightings(spark, clean_path, target)
    found = served.ServedDocuments(spark, target).geonear(radius_m=RADIUS_M, limit=1000, **CENTER)
    return found.select("id", "lng", "lat", "distance_m")


@query
def slim_catalog(spark, sf):
    rows = cat.slim_catalog(fx.species_responses(spark, sf))
    return _text(rows.select("*", "stats.*").drop("stats"), "types")
