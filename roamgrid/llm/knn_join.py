"""Exact top-k inner products by a Voronoi join.

Inner products become distances: with M the largest norm, a row x gets the extra coordinate sqrt(M^2 - |x|^2) and a query q the
coordinate 0, and then |q - x|^2 = |q|^2 + M^2 - 2 q.x. Pivots are rows of the data. Queries are grouped by their nearest
pivot, rows by theirs; small summaries (the reach of every query group, the distances of the nearest rows of every cell to its pivot)
bound, by the triangle inequality, how far the k-th neighbour of any query of a group can be. A row goes to a query group only
if its distance to the group's pivot allows it to be that near. Each group is solved with matrix products over blocks of rows, and
the best of the blocks are merged. Equal queries are solved once, and of equal rows only the k + 1 smallest ids are sent, as
no other can be in an answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from roamgrid.llm.embedding_forest import finite
from roamgrid.session import materialize

SCALE = 256
PIVOTS = (8, 64)
ROWS_PER_TASK = 20_000
QUERIES_PER_TASK = 4096
_SLACK = 1e-6


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, size)


def _lifted(x: np.ndarray, largest: float) -> np.ndarray:
    return np.concatenate([x, np.sqrt(np.maximum(0, largest**2 - (x * x).sum(1)))[:, None]], axis=1)


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (x * x).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(0, squares))


def _pivot_rows(shared, size: int, queries: bool):
    """Adds the nearest pivot and the distances to all pivots."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, largest = shared.value
        for batch in batches:
            x = _matrix(batch.column("v"), size)
            x = np.concatenate([x, np.zeros((len(x), 1))], axis=1) if queries else _lifted(x, largest)
            far = _distances(x, pivots)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(far.argmin(1).astype(np.int32)), pa.array(list(far), pa.list_(pa.float64()))],
                names=[*batch.schema.names, "cell", "far"])
    return run


def bounds(pivots: np.ndarray, reach: dict[int, float], nearest: dict[int, list[float]], k: int) -> dict[int, float]:
    """For every query group the distance from its pivot beyond which no row can be among the ``k`` nearest of its queries."""
    between = _distances(pivots, pivots)
    out = {}
    for i, own in reach.items():
        ways = np.sort(np.concatenate([own + between[i, j] + np.array(t) for j, t in nearest.items()]))
        out[i] = float(own + ways[k - 1] * (1 + _SLACK) + _SLACK) if len(ways) >= k else float("inf")
    return out


def _solve(k: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        query = rows["is_query"].to_numpy()
        asked, data = rows[query], rows[~query].sort_values("id")
        if not len(data) or not len(asked):
            return pd.DataFrame({"query": [], "vec_id": [], "score": []}).astype("int64")
        q, x = (np.stack(r["v"].to_numpy()).astype(np.int64) for r in (asked, data))
        exact = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * x.shape[1] < 2**52
        kind = np.float64 if exact else np.int64
        ids, out = data["id"].to_numpy(), []
        for at in range(0, len(q), 256):
            scores = q[at: at + 256].astype(kind) @ x.T.astype(kind)
            best = np.argsort(-scores, axis=1, kind="stable")[:, :k]
            out.append(pd.DataFrame({"query": np.repeat(asked["id"].to_numpy()[at: at + 256], best.shape[1]),
                                     "vec_id": ids[best].ravel(),
                                     "score": np.take_along_axis(scores, best, 1).ravel().astype(np.int64)}))
        return pd.concat(out)
    return run


def top_inner(rows: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows with the largest inner product for each query, never the query's own id.

    ``rows`` and ``queries`` have ``vec_id`` and ``v`` (arrays of longs of one length, without nulls). Ties go to the smaller
    id. A query has fewer results if there are fewer rows, and none if there are none. Null ids take no part.
    """
    rows = materialize(rows.filter("vec_id is not null").distinct(), "rows")
    queries = materialize(queries.filter("vec_id is not null").distinct(), "queries")
    several = W.partitionBy("v").orderBy("vec_id")
    data = materialize(rows.withColumn("nth", F.row_number().over(several)).filter(F.col("nth") <= k + 1).select("vec_id", "v"), "data")
    asked = materialize(queries.groupBy("v").agg(F.min("vec_id").alias("id")), "asked")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    size, largest = rows.agg(F.max(F.size("v")), F.max(norm)).first()
    wanted = int(np.clip(np.ceil(np.sqrt(asked.count()) / 4), *PIVOTS))
    picked = [r["v"] for r in data.select("vec_id", "v").orderBy(F.xxhash64("vec_id", F.lit(5)), "vec_id").limit(wanted).collect()]
    schema = "query_id long, rank int, vec_id long, score long"
    if not picked:
        return rows.sparkSession.createDataFrame([], schema)
    largest = float(largest) * (1 + _SLACK)
    pivots = _lifted(np.unique(np.array(picked, dtype=np.float64), axis=0), largest)
    shared = rows.sparkSession.sparkContext.broadcast((pivots, largest))
    near = materialize(data.mapInArrow(_pivot_rows(shared, size, False), "vec_id long, v array<long>, cell int, far array<double>"), "near")
    groups = materialize(asked.select("id", "v").mapInArrow(
        _pivot_rows(shared, size, True), "id long, v array<long>, cell int, far array<double>"), "groups")

    # Summaries have a row per pivot (at most PIVOTS[1]): reach and number of its queries, and k + 1 distances.
    own = F.get("far", F.col("cell"))
    summary = groups.groupBy("cell").agg(F.max(own).alias("reach"), F.count("*").alias("queries")).collect()
    least = near.select("cell", own.alias("d")).withColumn("nth", F.row_number().over(W.partitionBy("cell").orderBy("d"))).filter(
        F.col("nth") <= k + 1).groupBy("cell").agg(F.collect_list("d").alias("d")).collect()
    limit = bounds(pivots, {r["cell"]: r["reach"] for r in summary}, {r["cell"]: r["d"] for r in least}, k + 1)

    allowed = F.array(*[F.struct(F.lit(i).alias("group"), F.lit(d).alias("limit")) for i, d in sorted(limit.items())])
    needed = near.withColumn("to",
                             F.explode(F.filter(allowed, lambda a: F.get("far", a["group"]) <= a["limit"])))
    sent = needed.select(F.col("to.group").alias("group"), F.col("vec_id").alias("id"), "v", F.lit(False).alias("is_query"))
    load = sent.groupBy("group").agg(F.ceil(F.count("*") / ROWS_PER_TASK).cast("int").alias("salts")).collect()
    salts = F.create_map(*[F.lit(int(x)) for r in load for x in (r["group"], r["salts"])])
    parts = F.create_map(*[F.lit(int(x)) for r in summary for x in (r["cell"], -(-r["queries"] // QUERIES_PER_TASK))])

    def every(count):
        return F.explode(F.sequence(F.lit(0), count - 1))

    left = sent.withColumn("salt", F.pmod(F.xxhash64("id"), salts[F.col("group")]).cast("int")).withColumn("part", every(parts[F.col("group")]))
    right = groups.select(F.col("cell").alias("group"), "id", "v", F.lit(True).alias("is_query")).withColumn(
        "part", F.pmod(F.xxhash64("id"), parts[F.col("group")]).cast("int")).withColumn("salt", every(salts[F.col("group")]))
    solved = left.unionByName(right).groupBy("group", "part", "salt").applyInPandas(
        _solve(k + 1), "query long, vec_id long, score long")
    ranked = W.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = solved.withColumn("nth", F.row_number().over(ranked)).filter(F.col("nth") <= k + 1)
    members = queries.join(asked.withColumnRenamed("v", "w"), F.col("v") == F.col("w")).select(
        F.col("vec_id").alias("query_id"), F.col("id").alias("query"))
    each = members.join(best, "query").filter("vec_id != query_id")
    final = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("rank", F.row_number().over(final)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search(embeddings: DataFrame, every: int = 50, k: int = 5, scale: int = SCALE) -> DataFrame:
    """``top_inner`` of the rows whose id is divisible by ``every`` against all rows, on components ``floor(scale * x)``.

    Vectors that are null or hold null or non-finite components take no part; shorter ones are continued by zeros. Repeated
    rows are one row; one id with several vectors stands for each of them. Extra columns are ignored.
    """
    rows = embeddings.filter(finite(F.col("embedding"))).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(
        "embedding", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"))
    size = rows.agg(F.max(F.size("v"))).first()[0] or 0
    rows = rows.withColumn("v", F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(size) - F.size("v"))))
    return top_inner(rows, rows.filter(F.col("vec_id") % every == 0), k)
