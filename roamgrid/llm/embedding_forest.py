"""Near-duplicate embeddings by a forest of random-projection trees with spill overlap.

The trees of every label are fitted to a bounded sample: a node splits at the median of a random projection until few sample rows are
left. Every vector is routed down all trees and goes into both children where it is within ``spill`` of a threshold, so
close vectors part only if the threshold falls well between them. A leaf with more rows than ``BLOCK`` is split on by a tree
fitted to a sample of its own rows, level by level, so leaves stay small as the table grows. Vectors that share a leaf are compared in
full, in matrix blocks; a leaf that no projection divides, a crowd of near copies, is cut into blocks, and pairs of
blocks are compared in tasks of their own.
A pair that meets in several leaves counts in the first one only, which both rows know from their leaf lists, so links are
counted without listing pairs; a task returns one row per vector: its links and the smallest vector it is connected to.
Equal vectors are one weighted row from the start.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roamgrid.llm.components import components
from roamgrid.llm.shared import long_list
from roamgrid.session import materialize

TREES = 6
LEAF = 512
LEAST_LEAF = 32
SPILL = 0.03
SAMPLE = 65_536
SAMPLE_BYTES = 256 << 20
BLOCK = 2048
# Trees of a single leaf: rows they are fitted to, rows of a task that routes, and their spill; leaves are small, and copies by the spill
# multiply with every level.
LEAF_SAMPLE = 8192
LEAF_PART = 20_000
LEAF_SPILL = 0.01


def finite(vector: Column) -> Column:
    """Whether a vector and all its components are neither null nor infinite nor NaN."""
    return F.coalesce(vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))


def padded(vector: Column, size: int) -> Column:
    """Shorter vectors continued by zeros."""
    return F.concat(vector, F.array_repeat(F.lit(0.0).cast("double"), F.lit(size) - F.size(vector)))


class Tree:
    """Nodes as arrays; a leaf has no children and the number ``leaf``."""

    def __init__(self, first_leaf: int):
        self.directions, self.thresholds, self.children, self.leaf = [], [], [], []
        self.next_leaf = first_leaf

    def grow(self, rows: np.ndarray, least: int, spill: float, rng: np.random.Generator) -> int:
        node = len(self.children)
        self.children.append(None)
        self.directions.append(None)
        self.thresholds.append(0.0)
        self.leaf.append(-1)
        if len(rows) > least:
            for _ in range(3):
                direction = rng.normal(size=rows.shape[1])
                direction = (direction / np.linalg.norm(direction)).astype(np.float32)
                at = rows @ direction
                threshold = float(np.median(at))
                left, right = at <= threshold + spill, at >= threshold - spill
                # A crowd of near copies lies within the spill; splitting it again would only repeat it.
                if max(left.sum(), right.sum()) < 0.85 * len(rows):
                    self.directions[node], self.thresholds[node] = direction, threshold
                    self.children[node] = (self.grow(rows[left], least, spill, rng), self.grow(rows[right], least, spill, rng))
                    return node
        self.leaf[node] = self.next_leaf
        self.next_leaf += 1
        return node

    def route(self, x: np.ndarray, spill: float) -> Iterator[tuple[np.ndarray, int]]:
        """``(rows, leaf)`` for every leaf that rows of ``x`` reach."""
        todo = [(np.arange(len(x)), 0)]
        while todo:
            rows, node = todo.pop()
            if not len(rows):
                continue
            if self.children[node] is None:
                yield rows, self.leaf[node]
                continue
            at = x[rows] @ self.directions[node]
            left, right = self.children[node]
            todo += [(rows[at <= self.thresholds[node] + spill], left), (rows[at >= self.thresholds[node] - spill], right)]


def fit_forest(sample: dict, share: float, seed: int = 0) -> tuple[dict, int]:
    """Trees per label from unit vectors, and the first free leaf number. ``share``: of all rows, the part in the sample.

    Leaf numbers start at 1; leaf numbers of earlier trees are smaller. A label that is one leaf has one tree.
    """
    least = max(LEAST_LEAF, round(LEAF * share))
    forest, leaf, rng = {}, 1, np.random.default_rng(seed)
    for label in sorted(sample):
        trees = []
        for _ in range(TREES):
            tree = Tree(leaf)
            tree.grow(sample[label], least, SPILL, rng)
            leaf = tree.next_leaf
            trees.append(tree)
            if len(tree.children) == 1:
                break
        forest[label] = trees
    return forest, leaf


def _unit(column: pa.Array, size: int) -> np.ndarray:
    x = np.asarray(column.flatten(), dtype=np.float64).reshape(-1, size)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _route(shared, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x, labels = _unit(batch.column("vector"), size).astype(np.float32), np.asarray(batch.column("label"))
            places, found = [], []
            for label in np.unique(labels):
                rows = np.flatnonzero(labels == label)
                # A label outside the sample is one leaf, number 0.
                if label not in forest:
                    places.append(rows)
                    found.append(np.zeros(len(rows), dtype=np.int64))
                    continue
                for tree in forest[label]:
                    for some, leaf in tree.route(x[rows], SPILL):
                        places.append(rows[some])
                        found.append(np.full(len(some), leaf, dtype=np.int64))
            place, leaf = np.concatenate(places), np.concatenate(found)
            order = np.lexsort((leaf, place))
            lists = np.split(leaf[order], np.cumsum(np.bincount(place, minlength=len(labels)))[:-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, long_list(lists)], names=[*batch.schema.names, "leaves"])
    return run


def _units(column: pd.Series) -> np.ndarray:
    x = np.stack(column.to_numpy()).astype(np.float64)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def _fit_leaf(size: int, least: int, spill: float):
    """One tree over sampled rows of one leaf; it ends where about ``size`` rows of the whole leaf, or ``least`` sampled ones, are left."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        leaf, count = int(rows["leaf"].iloc[0]), int(rows["rows"].iloc[0])
        tree = Tree(0)
        ordered = rows.sort_values("vec")
        tree.grow(_units(ordered["vector"]), max(least, round(size * len(rows) / count)), spill, np.random.default_rng(leaf & (2**63 - 1)))
        return rows[["label", "leaf", "rows"]].iloc[:1].assign(tree=[pickle.dumps(tree)])
    return run


def _route_leaf(spill: float):
    """``label, vec, print, leaf, done``: the rows in the leaves of their leaf's tree; one that has no split, or none at all, is done."""
    def run(rows: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
        tree = pickle.loads(trees["tree"].iloc[0]) if len(trees) else Tree(0)
        if len(tree.children) < 2 or not len(rows):
            return rows[["label", "vec", "print", "leaf"]].assign(done=True)
        leaf, out = int(rows["leaf"].iloc[0]), []
        for some, child in tree.route(_units(rows["vector"]), spill):
            # Two leaves with one number would be compared together: more work, the same links.
            number = xxhash.xxh64_intdigest(f"{leaf}:{child}") >> 1
            out.append(rows.iloc[some][["label", "vec", "print"]].assign(leaf=number, done=False))
        return pd.concat(out)
    return run


def split_leaves(routed: DataFrame) -> DataFrame:
    """``routed`` with leaves of more than ``BLOCK`` rows replaced by those of trees of their own, until none is left that can be split.

    Each level fits a tree per such leaf to about ``LEAF_SAMPLE`` of its rows and routes its rows in parts of about ``LEAF_PART``.
    """
    routed = routed.withColumn("print", F.xxhash64("label", "vector"))
    vectors = routed.select("vec", "print", "vector")
    unsplit, ended = routed.select("label", "vec", "print", F.explode("leaves").alias("leaf")), []
    leaf = ["label", "leaf"]
    while True:
        sizes = unsplit.groupBy(*leaf).agg(F.count("*").alias("rows"))
        large = materialize(sizes.filter(F.col("rows") > BLOCK), "large_leaves")
        if large.isEmpty():
            break
        ended.append(unsplit.join(large, leaf, "left_anti"))
        rows = unsplit.join(large, leaf).join(vectors, ["vec", "print"])
        at = F.pmod(F.xxhash64("vec", "print", "leaf"), F.lit(1 << 30)) * F.col("rows")
        trees = rows.filter(at < F.lit(LEAF_SAMPLE << 30)).groupBy(*leaf).applyInPandas(
            _fit_leaf(LEAF, LEAST_LEAF, LEAF_SPILL), "label long, leaf long, rows long, tree binary")
        parts = F.ceil(F.col("rows") / LEAF_PART).cast("int")
        dealt = rows.withColumn("part", F.pmod(F.xxhash64("vec"), parts).cast("int"))
        each = materialize(trees, "leaf_trees").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
        key = [*leaf, "part"]
        moved = materialize(dealt.groupBy(*key).cogroup(each.groupBy(*key)).applyInPandas(
            _route_leaf(LEAF_SPILL), "label long, vec long, print long, leaf long, done boolean"), "split")
        ended.append(moved.filter("done").drop("done"))
        unsplit = moved.filter("not done").drop("done")
    if not ended:
        return routed.drop("print")
    lists = reduce(DataFrame.unionByName, ended, unsplit).groupBy("vec", "print").agg(
        F.sort_array(F.collect_set("leaf")).alias("leaves"))
    return materialize(routed.drop("leaves").join(lists, ["vec", "print"]).drop("print"), "routed")


def _compare(limit: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        leaf, one, two = (int(rows[c].iloc[0]) for c in ("leaf", "one", "two"))
        raw = np.stack(rows["vector"].to_numpy()).astype(np.float64)
        norms = np.linalg.norm(raw, axis=1)
        cosines = (raw / norms[:, None]) @ (raw / norms[:, None]).T
        a, b = np.nonzero(np.triu(cosines >= limit - 1e-9, 1))
        if one != two:
            cross = rows["block"].to_numpy()[a] != rows["block"].to_numpy()[b]
            a, b = a[cross], b[cross]
        close = np.abs(cosines[a, b] - limit) < 1e-9
        sure = ~close
        sure[close] = np.einsum("nd,nd->n", raw[a[close]], raw[b[close]]) / (norms[a[close]] * norms[b[close]]) >= limit
        a, b = a[sure], b[sure]
        ids = rows["vec"].to_numpy()
        own = np.unique(np.concatenate([a, b]))
        place = np.full(len(rows), -1)
        place[own] = np.arange(len(own))
        a, b = place[a], place[b]
        # Leaves before this one, as a matrix: rows with one in common met before.
        before = [[x for x in leaves if x < leaf] for leaves in rows["leaves"].to_numpy()[own]]
        names = {x: i for i, x in enumerate(sorted({x for xs in before for x in xs}))}
        held = np.zeros((len(own), len(names)), dtype=np.float32)
        for i, xs in enumerate(before):
            held[i, [names[x] for x in xs]] = 1
        new = (held @ held.T)[a, b] == 0
        weights = rows["weight"].to_numpy()[own]
        links = (np.bincount(a[new], weights[b[new]], len(own)) + np.bincount(b[new], weights[a[new]], len(own))).astype(np.int64)
        order = np.argsort(ids[own])
        root = np.empty(len(own), dtype=np.int64)
        root[order] = np.arange(len(own))
        while True:
            least = root.copy()
            np.minimum.at(least, a, root[b])
            np.minimum.at(least, b, root[a])
            least = np.minimum(least, least[order[least]])
            if (least == root).all():
                break
            root = least
        return pd.DataFrame({"vec": ids[own], "links": links, "root": ids[own][order[root]]})
    return run


def near_duplicates(embeddings: DataFrame, limit: float = 0.93) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vec_id, embedding, label``.

    Vectors with equal labels are linked when they meet in a leaf and their cosine in double precision is at least ``limit``. A
    null label, a vector that is null, zero or has null or non-finite components links with nothing; a null id has a null
    component and is not kept. Shorter vectors are continued by zeros. Equal rows count as vectors of their own. Extra
    columns are ignored. The trees are fitted to at most ``SAMPLE`` vectors and ``SAMPLE_BYTES``, those with the smallest hash of the id.
    """
    base = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                             F.col("embedding").cast("array<double>").alias("vector"))
    usable = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite(F.col("vector"))
              & F.exists("vector", lambda x: x != 0))
    size = max(1, base.agg(F.max(F.size("vector"))).first()[0] or 1)
    rows = materialize(base.select("vec_id", "label", F.when(usable, padded(F.col("vector"), size)).alias("vector")), "vectors")
    groups = materialize(rows.filter("vector is not null").groupBy("label", "vector").agg(
        F.min("vec_id").alias("vec"), F.count("*").alias("weight")), "groups")
    total, most = groups.count(), max(1, min(SAMPLE, SAMPLE_BYTES // (8 * size)))
    chosen = groups.filter(F.pmod(F.xxhash64("vec"), F.lit(1 << 20)) <= F.lit(int((1 << 20) * min(1.0, 1.2 * most / max(1, total)))))
    sample = chosen.orderBy(F.xxhash64("vec"), "vec").limit(most).select("label", "vector").toArrow()
    x = _unit(sample.column("vector").combine_chunks(), size).astype(np.float32) if total else np.zeros((0, size), dtype=np.float32)
    labels = np.asarray(sample.column("label"))
    forest, _ = fit_forest({int(v): x[labels == v] for v in np.unique(labels)}, len(x) / max(1, total))
    shared = embeddings.sparkSession.sparkContext.broadcast(forest)
    routed = split_leaves(materialize(groups.select("vec", "weight", "label", "vector").mapInArrow(
        _route(shared, size), "vec long, weight long, label long, vector array<double>, leaves array<long>"), "routed"))

    entries = routed.select("vec", "weight", "label", "vector", "leaves", F.explode("leaves").alias("leaf"))
    sizes = routed.select("label", F.explode("leaves").alias("leaf")).groupBy("label", "leaf").agg(
        F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    blocked = entries.join(sizes, ["label", "leaf"]).withColumn("block", F.pmod(F.xxhash64("vec"), "blocks").cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns(
        {"one": F.least("block", "other"), "two": F.greatest("block", "other")})
    found = materialize(blocked.select("label", "leaf", "one", "two", "block", "vec", "weight", "vector", "leaves")
                        .groupBy("label", "leaf", "one", "two").applyInPandas(_compare(limit), "vec long, links long, root long"), "found")
    links = found.groupBy("vec").agg(F.sum("links").alias("links"))
    parts = components(found.select(F.col("vec").alias("u"), F.col("root").alias("v")))
    result = (groups.join(links, "vec", "left").join(parts.withColumnRenamed("node", "vec"), "vec", "left").select(
        F.col("label").alias("l"), F.col("vector").alias("v"), F.coalesce("component", "vec").alias("component"),
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links")))
    joined = rows.join(result, (F.col("label") == F.col("l")) & (F.col("vector") == F.col("v")), "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    return joined.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                         F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"))
