"""Profiles of raw files: data quality (A11-A16) and repetition of points in three sampling views.

    python -m roamgrid.plans.profile RAW_GLOB CATALOG_JSON OUT [--sample N] [--prefix N] [--stride K] [--type water]
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roamgrid.operators import profile, spots
from roamgrid.operators.cleaning import judged
from roamgrid.session import drop_intermediate, materialize, use_utc
from roamgrid.sources.catalog import read_catalog
from roamgrid.sources.raw import read_raw, with_line_numbers
from roamgrid.sources.store import write_table


def profile_quality(raw: DataFrame, out: str, sample: int = 500_000, k: int = 12) -> dict[str, DataFrame]:
    """The text is parsed once; every table reads the staged rows."""
    rows = materialize(profile.profile_rows(raw), "profile")
    freq = write_table(profile.profile_freq(rows), out, "frequencies")
    sampled = write_table(profile.profile_sample(rows, sample), out, "sample")
    tables = {"files": profile.profile_files(rows), "top": profile.top_k(freq, k), "top_files": profile.top_k(freq, k, ("file",)),
              "rare": profile.top_k(freq, k, least=True), "cells": profile.cells_with_data(freq), "dups": profile.profile_dups(rows),
              "offsets": profile.profile_offsets(rows), "examples": profile.bad_examples(rows),
              "totals": profile.profile_totals(rows, sampled)}
    return {"frequencies": freq, "sample": sampled} | {name: write_table(df, out, name) for name, df in tables.items()}


def profile_spots(raw: DataFrame, catalog: DataFrame, out: str, type_name: str = "water", prefix: int = 500_000,
                  stride: int = 4) -> dict[str, DataFrame]:
    """Placed and dated documents with any species id."""
    documents = judged(with_line_numbers(raw)).filter(F.col("status") == "doc")
    placed = documents.dropna(subset=["lng", "lat", "appeared_utc", "species_id"])
    rows, counts = spots.stage_views(placed, catalog, type_name, prefix, stride)
    tables = {"views": spots.view_metrics(rows, counts), "histogram": spots.point_histogram(rows, ["view"]),
              "gap_rates": spots.gap_rates(counts, ["view"])}
    return {name: write_table(df, out, name) for name, df in tables.items()}


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("raw_glob")
    parser.add_argument("catalog")
    parser.add_argument("out")
    parser.add_argument("--sample", type=int, default=500_000)
    parser.add_argument("--prefix", type=int, default=500_000)
    parser.add_argument("--stride", type=int, default=4)
    parser.add_argument("--type", default="water")
    args = parser.parse_args()
    spark = use_utc(SparkSession.builder.appName("roamgrid-profile").getOrCreate())
    raw = read_raw(spark, args.raw_glob)
    tables = profile_quality(raw, args.out, args.sample)
    tables |= profile_spots(raw, read_catalog(spark, args.catalog), args.out, args.type, args.prefix, args.stride)
    for name, table in tables.items():
        print(name)
        table.show(20, truncate=False)
    drop_intermediate(spark)


if __name__ == "__main__":
    main()
