"""Positions of rows in long groups, without a task that holds a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from roamgrid.session import materialize


def numbered(rows: DataFrame, group: str, order: list[Column], name: str = "at") -> DataFrame:
    """``rows`` with their position (from 1) in their ``group`` by ``order``, which has to be unique within a group.

    Rows are range-partitioned by group and order, so a group of any size is cut into parts; a position is the place in the part
    plus the rows of the parts before it. Only narrow rows should be passed: they are written once and moved twice.
    """
    placed = materialize(rows.repartitionByRange(F.col(group).asc_nulls_first(), *order).withColumn("__part", F.spark_partition_id()),
                         "ordered")
    parts = placed.groupBy(F.col(group).alias("__group"), F.col("__part").alias("__p")).agg(F.count("*").alias("__n"))
    before = parts.withColumn("__before", F.sum("__n").over(
        W.partitionBy("__group").orderBy("__p").rowsBetween(W.unboundedPreceding, 0)) - F.col("__n"))
    # A part that is not the first of its group needs an offset; there is at most one for each range partition.
    offsets = before.filter("__before > 0").select("__group", "__p", "__before")
    inside = placed.withColumn(name, F.row_number().over(W.partitionBy(group, "__part").orderBy(*order)).cast("long"))
    joined = inside.join(offsets, F.col("__group").eqNullSafe(F.col(group)) & (F.col("__p") == F.col("__part")), "left")
    return joined.withColumn(name, F.col(name) + F.coalesce("__before", F.lit(0))).drop("__part", "__group", "__p", "__before")


def streamed(rows: DataFrame, *keys: str | Column, by: str) -> DataFrame:
    """``rows`` with all rows of a value of ``by`` in one partition, sorted by ``keys``: input of a task that reads them one by one."""
    return rows.repartition(by).sortWithinPartitions(*keys)
