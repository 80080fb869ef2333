"""Exact interpolated quantiles of whole numbers without collecting a group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_quantiles(df: DataFrame, value: str, weight: str, probs: list[float], by: list[str] | None = None,
                    width: int = 3600) -> DataFrame:
    """Rows ``(by..., p, value)`` with the linearly interpolated quantiles of an integer column that occurs ``weight``
    times per row.

    Values are counted first (combined on the map side). Counts per range of ``width`` values locate the ranges that
    hold the wanted ranks, and only those ranges are counted through value by value. No window here is longer than the
    number of ranges or than ``width``, however many rows share a group.
    """
    by = by or []
    counts = df.groupBy(*by, F.col(value).alias("v")).agg(F.sum(weight).alias("n")) \
        .withColumn("range", F.floor(F.col("v") / width))
    ranges = counts.groupBy(*by, "range").agg(F.sum("n").alias("in_range"))
    group = Window.partitionBy(*by)
    placed = ranges.withColumns({
        "before": F.coalesce(F.sum("in_range").over(
            group.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "total": F.sum("in_range").over(group),
    })
    asked = placed.withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
    position = (F.col("total") - 1) * F.col("p")
    asked = asked.withColumn("share", position - F.floor(position)).withColumn("rank", F.explode(F.array_distinct(
        F.array(F.floor(position), F.ceil(position)))))
    here = (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("in_range"))
    wanted = asked.filter(here).select(*by, "range", "p", "share", "rank", "before")
    # Two ranks per group and probability.
    inside = counts.join(F.broadcast(wanted), [*by, "range"])
    running = Window.partitionBy(*by, "p", "rank").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    reached = inside.withColumn("upto", F.col("before") + F.sum("n").over(running))
    hit = reached.filter((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
    low, high = F.min("v"), F.max("v")
    return hit.groupBy(*by, "p").agg((low + (high - low) * F.max("share")).alias(value))
