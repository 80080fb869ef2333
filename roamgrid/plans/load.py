"""Clean table to the document table, ignoring ids that are there already.

    python -m roamgrid.plans.load CLEAN DOCUMENTS [--replace]
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from roamgrid.session import drop_intermediate, use_utc
from roamgrid.sources.store import load_sightings


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("clean")
    parser.add_argument("documents")
    parser.add_argument("--replace", action="store_true")
    args = parser.parse_args()
    spark = use_utc(SparkSession.builder.appName("roamgrid-load").getOrCreate())
    load_sightings(spark, args.clean, args.documents, args.replace).orderBy("input_file").show(truncate=False)
    drop_intermediate(spark)


if __name__ == "__main__":
    main()
