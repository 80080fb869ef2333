"""Session set-up, the shared working folder, and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
# Rows a derived side may have and still be broadcast. Sides checked against it are narrow (numbers and an id),
# so this is a few tens of megabytes at most.
BROADCAST_ROWS = 200_000


def use_utc(spark: SparkSession) -> SparkSession:
    """All timestamps here are UTC instants; local time is derived from the longitude, never from the session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def local_session(cpus: int | str = 8, name: str = "roamgrid") -> SparkSession:
    """A single-machine session for tests and benchmarks. On a cluster the caller brings the session."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. A temporary folder of this machine is used
    only in local mode, where the driver and the executors are one process.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="roamgrid-")
        spark.conf.set(CHECKPOINT_DIR, root)
    return f"{root.rstrip('/')}/roamgrid-{name}-{uuid.uuid4().hex}"


# Intermediate tables of this process, for ``drop_intermediate``.
_WRITTEN: list[str] = []


def drop_intermediate(spark: SparkSession) -> None:
    """Delete the intermediate tables that this process has written. For the end of a job: nothing may read them any more."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    while _WRITTEN:
        path = hadoop(_WRITTEN.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, for inputs that several aggregates reuse."""
    path = work_path(df.sparkSession, name)
    _WRITTEN.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt over one partition per core or shuffle partition, whichever is more: for small tables of which much work is made."""
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """Mark ``df`` for broadcast when it has at most ``max_rows`` rows; counting stops one row past the bound."""
    small = df.limit(max_rows + 1).count() <= max_rows
    return (F.broadcast(df) if small else df), small
