"""Newline-delimited raw files: scan, physical line numbers, systematic and prefix samples.

A row is located by ``file``, ``block`` (start of its split in the file) and ``seq``, which grows within a split. The
triple orders rows as the files do without numbering them; ``with_line_numbers`` is needed only for line-based samples.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roamgrid.session import broadcast_if_small, materialize

POSITION = ["file", "block", "seq"]
# One numeric row per split, under 50 bytes: 2,000,000 splits of 128 MB are 256 TB of text.
_MAX_BROADCAST_SPLITS = 2_000_000


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Lines of all files under ``path`` (a glob), split by Spark into ranges."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), "value")


def _before() -> Window:
    return Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)


def split_table(raw: DataFrame) -> DataFrame:
    """Per split: its first ``seq``, its lines, and the lines of the file before it. One counting pass, written once."""
    counted = raw.groupBy("file", "block").agg(F.min("seq").alias("first_seq"), F.count(F.lit(1)).alias("lines"))
    return materialize(counted, "splits").withColumn(
        "lines_before", F.coalesce(F.sum("lines").over(_before()), F.lit(0)))


def with_line_numbers(raw: DataFrame, splits: DataFrame | None = None) -> DataFrame:
    """Add the 0-based physical ``line`` of every row in its file, blank lines included, without sorting the rows.

    The rows are joined with the offset of their split, found in another scan. Spark derives the size of splits from the cores that it
    sees, so the two scans may cut files differently; a row whose split was not counted, or which is not among the
    counted lines of it, stops the job instead of being lost or numbered wrongly. The side is numeric, 32 bytes a split.
    """
    splits = split_table(raw) if splits is None else splits
    narrow = splits.select(F.xxhash64("file").alias("_file"), F.col("block").alias("_block"), "first_seq", "lines", "lines_before")
    side, _ = broadcast_if_small(narrow, _MAX_BROADCAST_SPLITS)
    placed = raw.join(side, (F.xxhash64("file") == F.col("_file")) & (F.col("block") == F.col("_block")), "left")
    at = F.col("seq") - F.col("first_seq")
    counted = F.coalesce((at >= 0) & (at < F.col("lines")), F.lit(False))
    lost = F.raise_error(F.concat(F.lit("the scans of the raw files cut them differently; fix spark.sql.files.minPartitionNum: "), F.col("file")))
    line = F.when(counted, F.col("lines_before") + at).otherwise(lost.cast("long"))
    return placed.select(*[F.col(c) for c in raw.columns], line.alias("line"))


def scan_plan(splits: DataFrame, stride: int = 1) -> DataFrame:
    """Per file: its lines and how many of them a stride takes."""
    files = splits.groupBy("file").agg(F.sum("lines").alias("lines"))
    return files.withColumn("lines_taken", F.ceil(F.col("lines") / F.lit(stride)))


def stride_sample(numbered: DataFrame, stride: int) -> DataFrame:
    """Every ``stride``-th physical line of each file, from its first line on."""
    if stride < 1:
        raise ValueError("stride must be at least 1")
    return numbered if stride == 1 else numbered.filter(F.col("line") % stride == 0)


def prefix_sample(numbered: DataFrame, n: int) -> DataFrame:
    """The first ``n`` physical lines of each file."""
    return numbered.filter(F.col("line") < n)


def parsed_prefix(parsed: DataFrame, n: int) -> DataFrame:
    """The first ``n`` documents of each file; blank and broken lines do not count. ``parsed`` has ``status``.

    A file is never sorted as a whole: counts per split tell which splits are in, and only the split where a file
    crosses the bound is numbered, to find the last row that is taken.
    """
    docs = parsed.filter(F.col("status") == "doc")
    counted = materialize(docs.groupBy("file", "block").agg(F.count(F.lit(1)).alias("docs")), "docs")
    counted = counted.withColumn("docs_before", F.coalesce(F.sum("docs").over(_before()), F.lit(0)))
    left = F.lit(n) - F.col("docs_before")
    full = counted.filter(left >= F.col("docs")).select("file", "block", F.lit(None).cast("long").alias("last_seq"))
    crossing = counted.filter((left > 0) & (left < F.col("docs"))).select("file", "block", left.alias("take"))
    side, _ = broadcast_if_small(crossing, _MAX_BROADCAST_SPLITS)
    numbered = docs.select("file", "block", "seq").join(side, ["file", "block"]).withColumn(
        "nth", F.row_number().over(Window.partitionBy("file", "block").orderBy("seq")))
    cut = numbered.filter(F.col("nth") == F.col("take")).select("file", "block", F.col("seq").alias("last_seq"))
    bounds, _ = broadcast_if_small(materialize(full.unionByName(cut), "prefix"), _MAX_BROADCAST_SPLITS)
    kept = docs.join(bounds, ["file", "block"])
    return kept.filter(F.col("last_seq").isNull() | (F.col("seq") <= F.col("last_seq"))).drop("last_seq")
