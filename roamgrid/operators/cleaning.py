"""Raw lines to the clean table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roamgrid.functions import documents as D
from roamgrid.functions.once import compute_once
from roamgrid.functions.times import local_columns, parse_utc
from roamgrid.schemas import RAW_DATE, RAW_ID, RAW_LOCAL_TIME, RAW_LOCATION, RAW_SOURCE, RAW_SPECIES
from roamgrid.sources.raw import POSITION

EVENT_KEY = ["species_id", "lng", "lat", "appeared_utc"]


def parse_lines(raw: DataFrame) -> DataFrame:
    """Add ``status`` (blank, invalid, doc) and the typed document ``doc``."""
    line, doc = F.col("value"), F.col("doc")
    status = F.when(D.is_blank(line), "blank").when(D.is_broken(line, doc), "invalid").otherwise("doc")
    return compute_once(compute_once(raw, doc=D.typed_document(line)), status=status)


def flatten_raw(parsed: DataFrame) -> DataFrame:
    """The nested document as flat columns; rows that are no document have only NULLs there."""
    doc = F.col("doc")
    lng, lat = D.lng_lat(doc)
    is_doc = F.col("status") == "doc"
    flat = {
        "id": doc[RAW_ID]["$oid"],
        "species_id": doc[RAW_SPECIES],
        "source": F.coalesce(doc[RAW_SOURCE], F.lit("None")),
        "kind": doc[RAW_LOCATION]["type"],
        "lng": lng,
        "lat": lat,
        "date_text": doc[RAW_DATE]["$date"],
        "local_time": doc[RAW_LOCAL_TIME],
    }
    kept = [c for c in parsed.columns if c not in ("doc", "value")]
    return parsed.select(*kept, *[F.when(is_doc, c).alias(n) for n, c in flat.items()])


def with_reason(flat: DataFrame) -> DataFrame:
    """Add ``appeared_utc`` and ``reason``: blank lines and broken lines by their status, documents by the rules."""
    dated = compute_once(flat, appeared_utc=parse_utc(F.col("date_text")))
    rule = D.discard_reason(*[F.col(c) for c in ("kind", "lng", "lat", "species_id", "appeared_utc")])
    status = F.col("status")
    return dated.withColumn("reason", F.when(status == "doc", rule).otherwise(status))


def judged(raw: DataFrame) -> DataFrame:
    return with_reason(flatten_raw(parse_lines(raw)))


def clean_rows(judged_rows: DataFrame) -> DataFrame:
    """The rows without a reason in the clean schema, still with their position."""
    good = judged_rows.filter(F.col("reason").isNull())
    typed = good.withColumn("species_id", F.col("species_id").cast("int")).withColumns(
        local_columns(F.col("appeared_utc"), F.col("lng")))
    return typed.select(*POSITION, "id", "species_id", "source", "lng", "lat", "appeared_utc", "appeared_local",
                        "local_hour", "local_dow")


def dedup(rows: DataFrame) -> DataFrame:
    """One row per (species, lng, lat, time) over all files: the first in file order.

    The smallest struct is the one with the first position. ``min`` combines on the map side, so any number of copies of
    one event leaves one row per task.
    """
    rest = [c for c in rows.columns if c not in (*EVENT_KEY, *POSITION)]
    first = F.min(F.struct(*POSITION, *rest)).alias("_row")
    return rows.groupBy(*EVENT_KEY).agg(first).select(*EVENT_KEY, "_row.*").select(*rows.columns)


def clean_report(judged_rows: DataFrame) -> DataFrame:
    """One row of counts: lines read, discards per rule, rows after the rules, duplicates, final rows.

    Rejected rows have no event key, so each reason is one group that combines before the shuffle, and the number of
    kept groups is the number of rows that the dedup keeps.
    """
    kept = F.col("reason").isNull()
    keyed = judged_rows.select("reason", *[F.when(kept, F.col(c)).alias(c) for c in EVENT_KEY])
    groups = keyed.groupBy("reason", *EVENT_KEY).agg(F.count(F.lit(1)).alias("n"))

    def rows_where(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    reason = F.col("reason")
    counts = groups.agg(
        rows_where(~reason.eqNullSafe("blank")).alias("lines_read"),
        rows_where(reason == "invalid").alias("invalid_json"),
        *[rows_where(reason == r).alias(f"bad_{r}") for r in D.REASONS],
        rows_where(kept).alias("after_rules"),
        F.count_if(kept).alias("final_rows"),
    )
    return counts.withColumn("duplicates", F.col("after_rules") - F.col("final_rows"))


def reason_counts(judged_rows: DataFrame) -> DataFrame:
    """Lines per outcome; rows to keep are ``ok``."""
    return judged_rows.groupBy(F.coalesce("reason", F.lit("ok")).alias("reason")).agg(F.count(F.lit(1)).alias("rows"))
