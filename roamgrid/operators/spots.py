"""Repetition of observation points: visits, consecutive pairs, mixes, sampling views.

Input rows have ``species_id, source, lng, lat, appeared_utc`` and their place in the raw files, ``file, line``.
Every metric takes ``by``, the grouping columns (``["view"]`` for the comparison of sampling views).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roamgrid.functions.bands import VISIT_BANDS, gap_band, point_key, visits_band
from roamgrid.functions.cells import merge_bits, species_bits, with_species_count
from roamgrid.operators.quantiles import exact_quantiles
from roamgrid.session import materialize
from roamgrid.sources.catalog import catalog_side, type_flag

GAP_PROBS = [0.1, 0.25, 0.5, 0.75, 0.9]
VIEWS = ["complete", "prefix", "stride"]
DAY_S = 86_400


def spot_rows(df: DataFrame) -> DataFrame:
    """Rows with ``point`` and whole seconds ``tsec``, one per (species, point, second): the first in file order."""
    rows = df.select("species_id", "source", "file", "line", "appeared_utc",
                     point_key(F.col("lng"), F.col("lat")).alias("point"),
                     F.unix_seconds("appeared_utc").alias("tsec"))
    first = F.min(F.struct("file", "line", "source", "appeared_utc")).alias("_row")
    return rows.groupBy("species_id", "point", "tsec").agg(first).select("species_id", "point", "tsec", "_row.*")


def with_views(rows: DataFrame, prefix: int, stride: int) -> DataFrame:
    """One copy of a row per view it belongs to: the whole population, the first lines of each file, every k-th line."""
    line = F.col("line")
    member = [F.lit(VIEWS[0]), F.when(line < prefix, VIEWS[1]), F.when(line % stride == 0, VIEWS[2])]
    return rows.withColumn("view", F.explode(F.array_compact(F.array(*member))))


def _share(part: Column, whole: Column) -> Column:
    return part.cast("double") / whole


def _percent(part: Column, whole: Column) -> Column:
    return part.cast("double") * 100 / whole


# ---- points ---------------------------------------------------------------------------------------------------------

def point_summary(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """All metrics over visits per point: A17, A18 and A25 in two combining aggregates."""
    by = by or []
    points = rows.groupBy(*by, "point").agg(F.count(F.lit(1)).alias("n"), *merge_bits(species_bits(F.col("species_id"))))
    points = with_species_count(points, rows, [*by, "point"], "distinct_species").select(
        *by, "n", "distinct_species", visits_band(F.col("n")).alias("band"))
    n, distinct, again = F.col("n"), F.col("distinct_species"), F.col("n") >= 2
    totals = points.groupBy(*by).agg(
        F.sum(n).alias("sightings"), F.count(F.lit(1)).alias("distinct_points"),
        F.coalesce(F.sum(F.when(again, n)), F.lit(0)).alias("_repeated_rows"), F.count_if(n == 1).alias("_once"),
        F.max(n).alias("max_at_point"),
        F.count_if(again).alias("repeated_points"), F.count_if(again & (distinct == 1)).alias("_single_species"),
        F.sum(F.when(again, distinct)).alias("_species"),
        *[F.count_if(F.col("band") == b).alias(f"_band{i}") for i, b in enumerate(VISIT_BANDS)],
    )
    return totals.select(
        *by, "sightings", "distinct_points", "max_at_point",
        _share(F.col("sightings"), F.col("distinct_points")).alias("mean_per_point"),
        _percent(F.col("_repeated_rows"), F.col("sightings")).alias("pct_in_repeated_points"),
        _percent(F.col("_once"), F.col("distinct_points")).alias("pct_points_seen_once"),
        "repeated_points",
        F.when(F.col("repeated_points") > 0, _percent(F.col("_single_species"), F.col("repeated_points")))
        .alias("pct_single_species"),
        F.when(F.col("repeated_points") > 0, _share(F.col("_species"), F.col("repeated_points")))
        .alias("mean_distinct_species"),
        F.array(*[F.struct(F.lit(b).alias("band"), F.col(f"_band{i}").alias("points"))
                  for i, b in enumerate(VISIT_BANDS)]).alias("histogram"),
    )


def point_stats(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    return point_summary(rows, by).drop("histogram", "repeated_points", "pct_single_species", "mean_distinct_species")


def point_histogram(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Points per band of visits; bands without points are 0."""
    return point_summary(rows, by).select(*(by or []), F.inline("histogram"))


def point_mix(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    return point_summary(rows, by).select(*(by or []), "repeated_points", "pct_single_species", "mean_distinct_species")


def species_simpson(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Chance that two random sightings share the species: the sum of squared shares, from exact integer sums."""
    counts = rows.groupBy(*(by or []), "species_id").agg(F.count(F.lit(1)).cast("decimal(19,0)").alias("n"))
    total = F.sum("n").cast("double")
    return counts.groupBy(*(by or [])).agg(
        (F.sum(F.col("n") * F.col("n")).cast("double") / (total * total)).alias("same_species_by_chance"))


# ---- consecutive pairs ----------------------------------------------------------------------------------------------

def pairs(rows: DataFrame, by: list[str] | None = None, carry: list[str] | None = None) -> DataFrame:
    """Consecutive sightings at one point: ``gap_s``, ``same_species``, ``same_source``, and ``carry`` columns of both
    as ``column`` and ``next_column``.

    A point may hold any share of the rows, so it is cut by day. Rows are one per (species, point, second), which
    bounds a day of a point; the pairs across days come from the first and last row of each day alone. Both branches
    read the same columns, so they share the shuffle by point and day.
    """
    by, carry = by or [], carry or []
    place, values = ["tsec", "file", "line"], ["species_id", "source", *carry]
    day = rows.select(*by, "point", F.floor(F.col("tsec") / DAY_S).alias("_day"), *place, *values)
    in_day = Window.partitionBy(*by, "point", "_day").orderBy(*place)
    across = Window.partitionBy(*by, "point").orderBy(*place)

    def following(window) -> dict[str, Column]:
        return {f"next_{c}": F.lead(c).over(window) for c in ["tsec", *values]}

    linked = day.withColumns(following(in_day))
    last = F.col("next_tsec").isNull()
    edges = linked.withColumn("_first", F.lag("tsec").over(in_day).isNull()).filter(F.col("_first") | last)
    bridged = edges.withColumn("_last", last).withColumns(following(across)).filter("_last").drop("_first", "_last")
    found = linked.unionByName(bridged).filter(F.col("next_tsec").isNotNull())
    return found.select(
        *by, (F.col("next_tsec") - F.col("tsec")).alias("gap_s"),
        (F.col("next_species_id") == F.col("species_id")).alias("same_species"),
        F.col("next_source").eqNullSafe(F.col("source")).alias("same_source"),
        *carry, *[f"next_{c}" for c in carry])


def pair_counts(rows: DataFrame, by: list[str] | None = None, carry: list[str] | None = None) -> DataFrame:
    """Pairs combined by gap and flags: every pair metric follows from this table, which has at most a few rows per
    second of the longest gap, however many sightings there are."""
    flags = ["gap_s", "same_species", "same_source", *(carry or []), *[f"next_{c}" for c in carry or []]]
    return pairs(rows, by, carry).groupBy(*(by or []), *flags).agg(F.count(F.lit(1)).alias("n"))


def _count(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))


def pair_summary(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rates over pairs (A20, A24); percentages of gaps up to 15 minutes, an hour, a day. No row without pairs."""
    gap, same, total = F.col("gap_s"), F.col("same_species"), F.sum("n")
    return counts.groupBy(*(by or [])).agg(
        total.alias("pairs"), _share(_count(same), total).alias("same_species_rate"),
        _percent(_count(gap <= 900), total).alias("pct_gap_15min"),
        _percent(_count(gap <= 3600), total).alias("pct_gap_1h"),
        _percent(_count(gap <= DAY_S), total).alias("pct_gap_24h"),
        _percent(_count(F.col("same_source")), total).alias("pct_same_source"),
        _count(same & (gap <= 900)).alias("near_dups"),
    ).filter(F.col("pairs").isNotNull())


def gap_quantiles(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Quantiles of the gap in hours, one column per probability."""
    seconds = exact_quantiles(counts, "gap_s", "n", GAP_PROBS, by)
    hours = F.col("gap_s") / 3600
    return seconds.groupBy(*(by or [])).agg(*[
        F.max(F.when(F.col("p") == p, hours)).alias(f"gap_h_p{round(p * 100)}") for p in GAP_PROBS])


def type_rates(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Share of pairs whose next sighting has the type, given that the current one has it or has not."""
    cur, nxt = F.col("has_type"), F.col("next_has_type")
    return counts.groupBy(*(by or [])).agg(
        F.when(_count(cur) > 0, _share(_count(cur & nxt), _count(cur))).alias("next_given_type"),
        F.when(_count(~cur) > 0, _share(_count(~cur & nxt), _count(~cur))).alias("next_given_other"))


def _beside(parts: list[DataFrame], by: list[str]) -> DataFrame:
    """Put summaries side by side. Each has one row per group, so a union and one aggregate do without a join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.groupBy(*by).agg(*[F.max(c).alias(c) for c in stacked.columns if c not in by])


def pair_stats(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    counts = materialize(pair_counts(rows, by), "pairs")
    summary = pair_summary(counts, by).drop("pct_same_source", "near_dups")
    return _beside([summary, gap_quantiles(counts, by)], by or []).filter(F.col("pairs").isNotNull())


def pair_by_gap(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Same-species rate per band of the gap; bands without pairs are absent."""
    return gap_rates(pair_counts(rows, by), by)


def gap_rates(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    banded = counts.withColumn("band", gap_band(F.col("gap_s")))
    return banded.groupBy(*(by or []), "band").agg(
        F.sum("n").alias("pairs"), _share(_count(F.col("same_species")), F.sum("n")).alias("same_species_rate"))


def near_dups(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Same species at the same point within 15 minutes, and their percentage of all sightings."""
    found = pair_summary(pair_counts(rows, by), by).select(*(by or []), "near_dups")
    total = rows.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("sightings"))
    both = _beside([found, total], by or [])
    return both.select(*(by or []), "near_dups",
                       _percent(F.col("near_dups"), F.col("sightings")).alias("pct_near_dups"))


def with_type(rows: DataFrame, catalog: DataFrame, type_name: str) -> DataFrame:
    """Add ``has_type``; a species without a catalog entry has no type."""
    flagged = rows.join(catalog_side(type_flag(catalog, type_name)), "species_id", "left")
    return flagged.withColumn("has_type", F.coalesce("has_type", F.lit(False)))


def type_share(flagged: DataFrame, by: list[str] | None = None) -> DataFrame:
    return flagged.groupBy(*(by or [])).agg(_share(F.count_if("has_type"), F.count(F.lit(1))).alias("share"))


def type_persistence(rows: DataFrame, catalog: DataFrame, type_name: str, by: list[str] | None = None) -> DataFrame:
    """Share of a type overall, and in the next sighting at a point given that the current one has it or has not."""
    flagged = with_type(rows, catalog, type_name)
    rates = type_rates(pair_counts(flagged, by, ["has_type"]), by)
    return _beside([type_share(flagged, by), rates], by or [])


def same_source(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    return pair_summary(pair_counts(rows, by), by).select(*(by or []), "pct_same_source")


# ---- views ----------------------------------------------------------------------------------------------------------

def view_coverage(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """First and last time, distinct UTC days, and the percentage of sightings per weekday (0 = Monday)."""
    by = by or ["view"]
    days = rows.groupBy(*by, F.to_date("appeared_utc").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.min("appeared_utc").alias("lo"), F.max("appeared_utc").alias("hi"))
    on = [F.coalesce(F.sum(F.when(F.weekday("day") == d, F.col("n"))), F.lit(0)) for d in range(7)]
    return days.groupBy(*by).agg(
        F.min("lo").alias("first_utc"), F.max("hi").alias("last_utc"), F.count(F.lit(1)).alias("distinct_days"),
        *[_percent(on[d], F.sum("n")).alias(f"pct_dow{d}") for d in range(7)])


def stage_views(df: DataFrame, catalog: DataFrame, type_name: str, prefix: int = 500_000,
                stride: int = 4) -> tuple[DataFrame, DataFrame]:
    """Rows per view and their pair counts, each written once: every metric of the comparison reads these two."""
    rows = with_views(with_type(materialize(spot_rows(df), "spots"), catalog, type_name), prefix, stride)
    return rows, materialize(pair_counts(rows, ["view"], ["has_type"]), "pairs")


def view_metrics(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """All point and pair metrics, one row per view."""
    by = ["view"]
    beside = _beside([
        point_summary(rows, by).drop("histogram"), pair_summary(counts, by), species_simpson(rows, by),
        gap_quantiles(counts, by), type_share(rows, by), type_rates(counts, by), view_coverage(rows, by)], by)
    return beside.withColumn("pct_near_dups", _percent(F.col("near_dups"), F.col("sightings")))


def compare_views(df: DataFrame, catalog: DataFrame, type_name: str, prefix: int = 500_000,
                  stride: int = 4) -> DataFrame:
    return view_metrics(*stage_views(df, catalog, type_name, prefix, stride))
