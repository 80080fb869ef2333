"""Packing documents into training sequences: best fit under conflicts.

A sequence (bin) holds ``capacity`` words. Two documents of one source, or of one cluster of duplicates, never share a bin. A document
longer than a bin fills whole bins on its own, and only its rest is packed. Open bins are kept by residual, each with
a bitmap of its sources and one of its clusters. A piece goes to the tightest bin that can take it: the search starts at the
smallest residual that fits and goes on through the successors until a bin without a conflict is found, or opens a new one.
Documents are dealt by a hash into shards of about ``shard_rows`` and every shard is packed by itself.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roamgrid.llm.shared import WORD_SQL
from roamgrid.session import materialize

CAPACITY = 2048
SHARD_ROWS = 8192
_SCHEMA = ("doc_id long, source string, cluster long, piece int, first_word long, n_words int, shard int, bin int, "
           "start int")


def best_fit(sizes: list[int], sources: list, clusters: list, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and start of each piece, for pieces of 1 to ``capacity`` words taken in the order given.

    A null source or cluster conflicts with nothing.
    """
    known = {s: i for i, s in enumerate(dict.fromkeys(s for s in sources if s is not None))}
    several = pd.Series(clusters, dtype="object").value_counts()
    marks = {c: i for i, c in enumerate(several.index[several > 1])}
    row = [known[s] if s is not None else len(known) for s in sources]
    # lacking[s, r]: open bins of residual r without source s; the last row counts all open bins.
    lacking = np.zeros((len(known) + 1, capacity + 1), dtype=np.int32)
    free: list[np.ndarray] = []
    source_bits, cluster_bits, residual = [], [], []
    buckets: list[dict[int, None]] = [{} for _ in range(capacity + 1)]
    bins, starts = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
    for i, size in enumerate(sizes):
        s = row[i]
        source_bit = 1 << s if s < len(known) else 0
        mark = marks.get(clusters[i])
        cluster_bit = 1 << mark if mark is not None else 0
        found = -1
        for r in np.flatnonzero(lacking[s, size:]) + size:
            found = next((b for b in buckets[r] if not (source_bits[b] & source_bit or cluster_bits[b] & cluster_bit)), -1)
            if found >= 0:
                break
        if found < 0:
            found = len(residual)
            residual.append(capacity)
            source_bits.append(0)
            cluster_bits.append(0)
            free.append(np.ones(len(known) + 1, dtype=np.int32))
        else:
            del buckets[residual[found]][found]
            lacking[:, residual[found]] -= free[found]
        bins[i], starts[i] = found, capacity - residual[found]
        residual[found] -= size
        source_bits[found] |= source_bit
        cluster_bits[found] |= cluster_bit
        if source_bit:
            free[found][s] = 0
        if residual[found]:
            buckets[residual[found]][found] = None
            lacking[:, residual[found]] += free[found]
    return bins, starts


def _pack_shard(capacity: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["rest", "hash", "doc_id"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        rested = rows[rows["rest"] > 0]
        plain = [None if pd.isna(x) else x for x in rested["source"]]
        bins, starts = best_fit(rested["rest"].tolist(), plain, rested["cluster"].tolist(), capacity)
        last = rested.assign(piece=rested["words"] // capacity, n_words=rested["rest"], bin=bins, start=starts)
        whole = rows.loc[rows.index.repeat(rows["words"] // capacity)]
        whole = whole.assign(piece=whole.groupby(level=0).cumcount(), n_words=capacity,
                             bin=np.arange(len(whole)) + (bins.max() + 1 if len(bins) else 0), start=0)
        empty = rows[rows["words"] == 0].assign(piece=0, n_words=0, bin=None, start=None)
        out = pd.concat([x for x in (last, whole, empty) if len(x)])
        out["first_word"] = out["piece"] * capacity
        ints = {c: "Int32" for c in ("piece", "n_words", "shard", "bin", "start")} | {"doc_id": "Int64"}
        return out[[c.split()[0] for c in _SCHEMA.split(", ")]].astype(ints)
    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """A row per piece: ``doc_id, source, cluster, piece, first_word, n_words, shard, bin, start``.

    ``cluster`` is a column of the input if there is one, else documents with equal texts are one cluster. Null and empty texts have
    one row without a bin. A null source conflicts with nothing. Repeated rows are packed as often as they come, into
    different bins. Only numbers and sources are moved, and a shard is a bounded number of rows whatever the sources are.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    cluster = F.col("cluster").cast("long") if "cluster" in docs.columns else F.xxhash64(text)
    items = materialize(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), cluster.alias("cluster"),
        F.regexp_count(text, F.lit(WORD_SQL)).cast("long").alias("words")), "items")
    shards = max(1, -(-items.count() // shard_rows))
    hashed = items.withColumns({"rest": F.col("words") % capacity, "hash": F.xxhash64("doc_id", "cluster"),
                                "nth": F.monotonically_increasing_id()})
    # Rows equal in id and cluster that are more than a share of a shard are dealt in blocks of about that share.
    share = max(1, shard_rows // 8)
    crowded = hashed.groupBy(F.col("hash").alias("h")).count().filter(F.col("count") > share).select(
        "h", F.ceil(F.col("count") / share).alias("blocks"))
    dealt = hashed.join(crowded, F.col("hash") == F.col("h"), "left").withColumn("shard", F.pmod(
        F.when(F.col("blocks").isNull(), F.xxhash64("hash", F.lit(7))).otherwise(
            F.xxhash64("hash", F.lit(7), F.pmod(F.xxhash64("nth"), "blocks"))), F.lit(shards)).cast("int")).drop("h", "blocks", "nth")
    return dealt.groupBy("shard").applyInPandas(_pack_shard(capacity), _SCHEMA)
