"""Tables laid out for lookups: files in the order of a space-filling curve, and a manifest of what each file holds.

The manifest stands in the folder of its table under a name that readers of the table skip. It has one row for each file, like the
listing of a table that Spark keeps on the driver anyway. A lookup picks files on the driver without a job and reads those
only; the filters on rows stay, so a file too many costs time and nothing else. Manifests follow from the files: a file
that is missing in one, after a stopped load for instance, is described at the next ``describe``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "_manifest"


def _listing(spark: SparkSession, path: str) -> list[str]:
    return [f.rsplit("/", 1)[1] for f in spark.read.parquet(path).inputFiles()]


def _manifest(spark: SparkSession, path: str) -> list:
    """The rows of the manifest, or none if there is no manifest."""
    try:
        return spark.read.parquet(f"{path}/{MANIFEST}").collect()
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return []
        raise


def describe(spark: SparkSession, path: str, *facts: Column, first: Callable[[DataFrame], None] | None = None) -> None:
    """Add the files that the manifest of ``path`` does not know; ``first`` is given their rows before they are added."""
    path = path.rstrip("/")
    known = {r["file"] for r in _manifest(spark, path)}
    fresh = [f for f in _listing(spark, path) if f not in known]
    if not fresh:
        return
    rows = spark.read.parquet(*(f"{path}/{f}" for f in fresh))
    if first:
        first(rows)
    rows.groupBy(F.col("_metadata.file_name").alias("file")).agg(*facts).coalesce(1).write.mode("append").parquet(f"{path}/{MANIFEST}")


def box_facts(lng: str = "lng", lat: str = "lat") -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"), F.min(lng).alias("west"), F.max(lng).alias("east"),
            F.min(lat).alias("south"), F.max(lat).alias("north")]


class Served:
    """A described table, opened for lookups. Open it again after a load."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        there = set(_listing(spark, self.path))
        self.entries = [r for r in _manifest(spark, self.path) if r["file"] in there]
        self.schema = spark.read.parquet(self.path).schema
        # Files that no manifest describes are read by every lookup, unless they are empty.
        self.unknown = sorted(there - {r["file"] for r in self.entries})

    def read(self, files: Iterable[str]) -> DataFrame:
        paths = [f"{self.path}/{f}" for f in [*files, *self.unknown]]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def overlapping(self, boxes: list[tuple[float, float, float, float]]) -> list:
        return [r for r in self.entries if any(
            r["west"] <= east and r["east"] >= west and r["south"] <= north and r["north"] >= south for west, south, east, north in boxes)]
