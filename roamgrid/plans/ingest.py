"""Raw files to the clean table, with the report of every discarded line.

    python -m roamgrid.plans.ingest RAW_GLOB OUT [--stride N] [--parts N]
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roamgrid.operators.cleaning import clean_rows, dedup, judged
from roamgrid.functions.documents import REASONS
from roamgrid.session import drop_intermediate, materialize, use_utc
from roamgrid.sources.raw import read_raw, scan_plan, split_table, stride_sample, with_line_numbers
from roamgrid.sources.store import read_clean, write_clean

CLEAN_TABLE, REPORT, FILES = "sightings", "clean_report", "scan_plan"


def ingest(spark: SparkSession, raw_glob: str, out: str, stride: int = 1, parts: int | None = None) -> DataFrame:
    """Write the clean table, its report and the scan plan under ``out``; returns the report.

    The text is parsed once: the judged rows are written to the shared folder, and both the counts and the clean table
    read that table, so a lost executor never changes a count.
    """
    use_utc(spark)
    raw = read_raw(spark, raw_glob)
    splits = split_table(raw)
    taken = raw if stride == 1 else stride_sample(with_line_numbers(raw, splits), stride)
    staged = materialize(judged(taken), "judged")
    table = f"{out.rstrip('/')}/{CLEAN_TABLE}"
    write_clean(dedup(clean_rows(staged)), table, parts)

    reason = F.col("reason")
    counts = staged.groupBy().agg(
        F.count_if(~reason.eqNullSafe("blank")).alias("lines_read"), F.count_if(reason == "invalid").alias("invalid_json"),
        *[F.count_if(reason == r).alias(f"bad_{r}") for r in REASONS],
        F.count_if(reason.isNull()).alias("after_rules"))
    final = F.lit(read_clean(spark, table).count())
    report = counts.withColumns({
        "final_rows": final, "duplicates": F.col("after_rules") - final, "stride": F.lit(stride)})
    report.write.mode("overwrite").json(f"{out.rstrip('/')}/{REPORT}")
    scan_plan(splits, stride).write.mode("overwrite").json(f"{out.rstrip('/')}/{FILES}")
    return spark.read.schema(report.schema).json(f"{out.rstrip('/')}/{REPORT}")


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("raw_glob")
    parser.add_argument("out")
    parser.add_argument("--stride", type=int, default=1)
    parser.add_argument("--parts", type=int)
    args = parser.parse_args()
    spark = SparkSession.builder.appName("roamgrid-ingest").getOrCreate()
    ingest(spark, args.raw_glob, args.out, args.stride, args.parts).show(truncate=False)
    drop_intermediate(spark)


if __name__ == "__main__":
    main()
