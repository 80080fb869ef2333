"""Parquet tables: clean table, document table, aggregate tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roamgrid.functions.cells import to_point, with_curve
from roamgrid.functions.times import local_date
from roamgrid.schemas import CLEAN, GRID_DEG
from roamgrid.session import materialize
from roamgrid.sources.manifest import Served, box_facts, describe

IDS = "_ids"
# Ranges of new ids that are held against the files of the id index.
_ID_RANGES = 256


def write_clean(df: DataFrame, path: str, parts: int | None = None) -> None:
    """Write the clean schema, balanced by Spark or in a given number of files."""
    rows = df.select(*CLEAN.fieldNames())
    rows = rows.hint("rebalance") if parts is None else rows.repartition(parts)
    rows.write.mode("overwrite").parquet(path)


def read_clean(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.schema(CLEAN).parquet(path)
    return df.select(*columns) if columns else df


def to_documents(clean: DataFrame) -> DataFrame:
    """Clean rows in the document shape: GeoJSON point, local date; no local timestamp. The coordinates also stand flat, as files have
    statistics only of flat columns."""
    return clean.select(
        F.col("id").alias("_id"), "species_id", "source", to_point("lng", "lat").alias("location"), "lng", "lat", "appeared_utc",
        local_date(F.col("appeared_local")).alias("local_date"), "local_hour", "local_dow")


def from_documents(documents: DataFrame) -> DataFrame:
    """Sightings as the operators take them; filters on them reach the scan."""
    return documents.select(
        F.col("_id").alias("id"), "species_id", "source", "lng", "lat", "appeared_utc", "local_date", "local_hour", "local_dow")


def _has_files(spark: SparkSession, path: str) -> bool:
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    try:
        return not found.load(path).select("path").isEmpty()
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            return False
        raise


def index_documents(spark: SparkSession, path: str) -> None:
    """Bring the id index and the manifest of a document table up to date with its files.

    Both follow from the files, so this may run at any time. Ids are written before the manifest names their files: a load that
    stops between the two leaves ids that are written again, never files without.
    """
    path = path.rstrip("/")

    def write_ids(rows: DataFrame) -> None:
        rows.select("_id").repartitionByRange("_id").sortWithinPartitions("_id").write.mode("append").parquet(f"{path}/{IDS}")

    describe(spark, path, *box_facts(), first=write_ids)
    describe(spark, f"{path}/{IDS}", F.min("_id").alias("first"), F.max("_id").alias("last"), F.count_if(F.col("_id").isNull()).alias("nulls"))


def known_ids(spark: SparkSession, path: str, ids: DataFrame) -> DataFrame:
    """Of the ids of a document table, those in the files of its index that may hold one of ``ids``.

    The ids are cut into ranges of like numbers, and a file is read when its own range meets one of them. Ids that grow with
    time meet the last files only.
    """
    cut = ids.repartitionByRange(_ID_RANGES, "id").groupBy(F.spark_partition_id()).agg(
        F.min("id").alias("low"), F.max("id").alias("high"), F.count_if(F.col("id").isNull()).alias("nulls")).collect()
    ranges = [(r["low"], r["high"]) for r in cut if r["low"] is not None]
    nulls = any(r["nulls"] for r in cut)
    index = Served(spark, f"{path.rstrip('/')}/{IDS}")
    hit = [e["file"] for e in index.entries if (nulls and e["nulls"]) or e["first"] is not None and any(
        low <= e["last"] and e["first"] <= high for low, high in ranges)]
    return index.read(hit)


def load_sightings(spark: SparkSession, clean_path: str, target: str, replace: bool = False) -> DataFrame:
    """Add the clean table to the document table, ignoring ids that are there already. Returns the load report.

    Of several rows with one id the first is kept. What is new is written to the shared folder first: the load and the
    report read the same rows, and running a load again inserts nothing. Of the ids that are there only those near the new ones
    are read, from an index beside the table.
    """
    rows = read_clean(spark, clean_path).select(
        "*", F.col("_metadata.file_name").alias("input_file"), F.col("_metadata.row_index").alias("row"))
    rest = [c for c in rows.columns if c not in ("id", "input_file", "row")]
    first = F.min(F.struct("input_file", "row", *rest)).alias("_row")
    new = materialize(rows.groupBy("id").agg(first).select("id", "_row.*"), "load")
    if not replace and _has_files(spark, target):
        index_documents(spark, target)
        known = known_ids(spark, target, new.select("id")).select(F.col("_id").alias("known"))
        new = materialize(new.join(known, F.col("id").eqNullSafe(F.col("known")), "left_anti"), "load")
    write_clustered(to_documents(new), target, by="_id", mode="overwrite" if replace else "append")
    index_documents(spark, target)
    return load_report(rows, new)


def load_report(rows: DataFrame, new: DataFrame) -> DataFrame:
    """Rows, inserted and duplicate ids per input file; the row without a file is the total."""
    read = rows.groupBy("input_file").agg(F.count(F.lit(1)).alias("rows"), F.lit(0).cast("long").alias("inserted"))
    inserted = new.groupBy("input_file").agg(F.lit(0).cast("long").alias("rows"), F.count(F.lit(1)).alias("inserted"))
    total = read.unionByName(inserted).rollup("input_file").agg(
        F.sum("rows").alias("rows"), F.sum("inserted").alias("inserted"))
    return total.withColumn("duplicate_ids", F.col("rows") - F.col("inserted"))


def write_table(df: DataFrame, root: str, name: str) -> DataFrame:
    """Overwrite one table and return it as read back, so that later steps use the written rows."""
    path = f"{root.rstrip('/')}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}")


def write_clustered(df: DataFrame, path: str, deg: float = GRID_DEG, parts: int | None = None, by: str = "id",
                    mode: str = "overwrite") -> None:
    """Write sightings in the order of a space-filling curve over cells, so that box filters skip files and row groups by their
    statistics in both directions. A cell stays together.

    The id ``by`` closes the range key: a cell with any share of the rows is spread over as many files as it needs.
    """
    key = ["_curve", "cx", "cy", "species_id", by]
    placed = with_curve(df, deg)
    ranged = placed.repartitionByRange(*key) if parts is None else placed.repartitionByRange(parts, *key)
    ranged.sortWithinPartitions(*key).drop("_curve", "cx", "cy").write.mode(mode).parquet(path)
