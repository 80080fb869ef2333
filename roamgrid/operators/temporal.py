"""Counts by local hour, weekday and date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roamgrid.functions.times import hour_key

GRANULARITIES = ("hour", "dow", "day")


def agg_time(df: DataFrame, granularity: str | None = None) -> DataFrame:
    """``granularity, key, count`` for one granularity or for all three.

    All three come from one scan: sightings are first combined by (hour, weekday, date), which leaves 24 rows per day.
    """
    if granularity is not None and granularity not in GRANULARITIES:
        raise ValueError(f"granularity must be one of {GRANULARITIES}")
    keys = {"hour": hour_key(F.col("local_hour")), "dow": F.col("local_dow").cast("string"), "day": F.col("local_date")}
    if granularity is not None:
        counts = df.groupBy(keys[granularity].alias("key")).agg(F.count(F.lit(1)).alias("count"))
        return counts.select(F.lit(granularity).alias("granularity"), "key", "count")
    small = df.groupBy("local_hour", "local_dow", "local_date").agg(F.count(F.lit(1)).alias("n"))
    entries = F.array(*[F.struct(F.lit(g).alias("granularity"), k.alias("key")) for g, k in keys.items()])
    return small.select(F.inline(entries), "n").groupBy("granularity", "key").agg(F.sum("n").alias("count"))


def peak(time: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Key with the highest count; on a tie the first key in listing order."""
    first = F.col(order or key)
    return time.orderBy(F.desc("count"), first.asc()).limit(1).select(key, "count")
