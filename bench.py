"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the cores. Every query runs once to warm up and then ``REPS``
times with every row computed; the median counts. ``grid_<rows>`` is the grid aggregation at the row counts of the
published reference timings, with the result brought to the driver, over Parquet that Spark derives from ``events``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import functions as F

from roamgrid.operators.grid import grid_bench
from roamgrid.session import local_session, materialize
from workload import fixtures
from workload.queries import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPS = int(os.environ.get("BENCH_REPS", "3"))
HEADLINE = ["grid_bench", "grid_cells", "hotspots", "time_all", "species_hour", "near", "near_species", "geonear", "served_near", "served_geonear", "served_within", "heat", "list_grid", "within", "near_join",
            "within_totals", "within_join", "dedup", "clean_report", "stride_sample", "profile_freq", "profile_dups",
            "point_stats", "pair_stats", "compare_views", "load_report"]
# Row counts of the published timings, and seconds of the fastest published configuration for each.
PUBLISHED = {560_006: 0.92, 1_120_489: 1.35, 2_239_470: 2.11}


def timed(run) -> float:
    run()
    seconds = []
    for _ in range(REPS):
        start = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 3)


def run_all(df) -> None:
    """Compute every row and column without moving them to this process."""
    df.write.format("noop").mode("overwrite").save()


def larger(spark, rows: int):
    """At least ``rows`` sightings in 8 Parquet files, as in the published runs: copies of all events, each copy moved to cells of its own, with about
    as many sightings per cell as in the published runs."""
    base = fixtures.placed_events(spark, SF_DIR).select("line", "species_id", "lng", "lat")
    copies = -(-rows // base.count())
    spread = base.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    moved = spread.select(
        "species_id", (F.col("lng") + F.col("copy") * 1.5 + F.col("line") % 59 / 100).alias("lng"),
        (F.col("lat") + F.col("line") % 13 / 25).alias("lat"))
    return materialize(moved.repartition(8), "bench")


def main() -> None:
    spark = local_session(CPUS, "roamgrid-bench")
    queries = {}
    for name in HEADLINE:
        queries[name] = timed(lambda: run_all(QUERIES[name](spark, SF_DIR)))
        print(name, queries[name], file=sys.stderr, flush=True)
    grid = {}
    for rows, published in PUBLISHED.items():
        table = larger(spark, rows)
        seconds = timed(lambda: grid_bench(table).toArrow())
        counted = table.count()
        grid[f"grid_{rows}"] = {"sec": seconds, "rows": counted, "rows_per_sec": round(counted / seconds),
                                "cells": grid_bench(table).count(), "published_sec": published}
    queries |= {name: entry["sec"] for name, entry in grid.items()}
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(queries.values()), 3), "unit": "sec",
                      "queries": queries, "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1], "cpus": CPUS,
                      "grid_at_published_rows": grid}))


if __name__ == "__main__":
    main()
