"""Near-duplicate documents by bottom-k sketches from one hash function.

1. One scan turns every whole text into its shingle set and keeps the ``k`` smallest fingerprints, the size of the set and a
   128-bit fingerprint of the word sequence. Equal word sequences are one node from here on, so a group of copies of any
   size costs one partial aggregate.
2. Retained values are inverted to lists. Two sets with similarity 0.8 share at least ``NEED`` of the ``k`` smallest values of their
   union (but for a chance of about one in 10^5 at the bound itself, far less above it), hence one of the ``k - NEED + 1`` values
   that come first when a sketch is ordered by (list length, value). Only those are kept in lists, and rare values come
   first, so a passage that many documents share makes no list of them unless little else is in their sketches.
3. The smallest node of a list is its hub, and the nodes of all lists of a hub are its group: nodes that share a list share a group,
   and the rows are linear in the lists. A group is cut into blocks of bounded rows, and pairs of blocks are tasks.
4. Overlaps of sketches and the union-sketch estimate, as matrices in a task, leave the nodes that have a possible partner. Only
   their texts are moved, and those that a bitmap of fixed size over the hashes of these nodes lets pass by chance.
5. Full shingle sets verify the possible pairs that are not yet connected inside a task. No pairs are written: a task returns one row per
   node, the smallest node it is connected to, and the components of all tasks are joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roamgrid.llm.components import components
from roamgrid.llm.shared import WordHashes, long_list, shingle_set, slices, text_words
from roamgrid.session import materialize

SKETCH = 32
# Of 32 values of a joint sketch, those that two sets of similarity 0.8 share: 25.6 on average, deviation 2.3.
NEED = 15
DEVIATIONS = 4.7
BLOCK_ROWS = 2048
BLOCK_SHINGLES = 1_500_000
# Bits of the filter on texts: 8 MB in rows of 4 KB at any size of the input.
FILTER_BITS = 1 << 26


def _sketch_rows(width: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches):
            sizes, high, low, sketches = [], [], [], []
            for text in batch.column("text").to_pylist():
                words = text_words(text)
                shingles = shingle_set(words, hashes, width)
                whole = xxhash.xxh128_intdigest(b" ".join(words))
                sizes.append(len(shingles))
                high.append((whole >> 64) - (1 << 63))
                low.append((whole & ((1 << 64) - 1)) - (1 << 63))
                sketches.append(shingles[:k])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("print"), pa.array(sizes, pa.int64()), pa.array(high, pa.int64()),
                 pa.array(low, pa.int64()), long_list(sketches)], names=["doc_id", "print", "n_shingles", "high", "low", "sketch"])
    return run


def text_print(text: Column) -> Column:
    """A digest of the text as it is; null and empty texts differ."""
    return F.coalesce(F.md5(text.cast("string").cast("binary")), F.lit(""))


def sketch_table(docs: DataFrame, width: int, k: int = SKETCH) -> DataFrame:
    """``doc_id, print, n_shingles, high, low, sketch`` of every document."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_print(F.col("text")).alias("print"),
                       F.col("text").cast("string").alias("text")).mapInArrow(
        _sketch_rows(width, k), "doc_id long, print string, n_shingles long, high long, low long, sketch array<long>")


def possible(sketches: list[np.ndarray], sizes: np.ndarray, k: int) -> np.ndarray:
    """The pairs (as a symmetric matrix) whose sketches allow a similarity of 0.8.

    Up to the smaller of two largest retained values both sketches are complete, so the shared values among all values up to
    there are a sample of the similarity; if both sets are retained whole, it is the similarity.
    """
    m = len(sketches)
    lengths = np.array([len(x) for x in sketches])
    values, codes = np.unique(np.concatenate(sketches), return_inverse=True)
    several = np.bincount(codes) > 1
    names = np.cumsum(several) - 1
    owner = np.repeat(np.arange(m), lengths)
    kept = several[codes]
    held = np.zeros((m, int(several.sum())), dtype=np.float32)
    held[owner[kept], names[codes[kept]]] = 1
    shared = held @ held.T
    # upto[i, j]: the values of sketch i that are at most the reach of sketch j.
    reach = np.array([x[-1] if n > k else np.iinfo(np.int64).max for x, n in zip(sketches, sizes)])
    upto = np.stack([np.searchsorted(x, reach, side="right") for x in sketches])
    lower = reach[:, None] <= reach[None, :]
    union = np.where(lower, lengths[:, None] + upto.T, upto + lengths[None, :]) - shared
    whole = (sizes[:, None] <= k) & (sizes[None, :] <= k)
    least = 0.8 * union - np.where(whole, 0, DEVIATIONS * 0.4 * np.sqrt(np.maximum(union, 0))) - 1e-6
    near = (shared > 0) & (shared >= least) & (np.minimum.outer(sizes, sizes) * 100 >= np.maximum.outer(sizes, sizes) * 80)
    np.fill_diagonal(near, False)
    return near


def _groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """The rows of equal keys, which arrive one after another, as tables."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        columns = [np.asarray(table.column(c)) for c in keys]
        change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        cuts = [0, *change.tolist(), table.num_rows]
        if held and any(held[-1].column(c)[-1].as_py() != c_[0] for c, c_ in zip(keys, columns)):
            yield pa.concat_tables(held)
            held = []
        for start, end in zip(cuts, cuts[1:]):
            held.append(table.slice(start, end - start))
            if end < table.num_rows:
                yield pa.concat_tables(held)
                held = []
    if held:
        yield pa.concat_tables(held)


def _apart(group: pa.Table) -> np.ndarray | None:
    """For a task of two blocks, the pairs between them; only those are new."""
    if group.column("one")[0].as_py() == group.column("two")[0].as_py():
        return None
    block = np.asarray(group.column("block"))
    return block[:, None] != block[None, :]


def _pairs(first: list[int], second: list[int], *names: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(first, pa.int64()), pa.array(second, pa.int64())], names=list(names))


def _candidates(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hubs, nodes = [], []
        for group in _groups(batches, ("hub", "one", "two")):
            if group.num_rows > 1:
                lists = group.column("sketch").combine_chunks()
                flat, cuts = np.asarray(lists.flatten()), np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths()))])
                near = possible([flat[a:b] for a, b in zip(cuts, cuts[1:])], np.asarray(group.column("n_shingles")), k)
                apart = _apart(group)
                found = np.asarray(group.column("node"))[(near if apart is None else near & apart).any(axis=1)]
                hubs += [group.column("hub")[0].as_py()] * len(found)
                nodes += found.tolist()
            if len(hubs) > 20_000:
                yield _pairs(hubs, nodes, "hub", "node")
                hubs, nodes = [], []
        yield _pairs(hubs, nodes, "hub", "node")
    return run


def connected(sets: list[np.ndarray], allowed: np.ndarray, percent: int) -> np.ndarray:
    """For each set the first set it is connected to by pairs that are ``allowed`` and reach the bound on full sets.

    A set is marked in a bitmap and counted in all its possible partners at once; partners it is connected to already
    need no count.
    """
    root = np.arange(len(sets))
    sizes = np.array([len(x) for x in sets])
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    mark = np.zeros(codes.max() + 1, dtype=np.int32)
    for i in np.argsort(-allowed.sum(axis=1), kind="stable"):
        partners = np.flatnonzero(allowed[i] & (root != root[i]))
        if not len(partners):
            continue
        own = codes[starts[i]: starts[i] + sizes[i]]
        mark[own] = 1
        parts = np.concatenate([codes[starts[p]: starts[p] + sizes[p]] for p in partners])
        both = np.add.reduceat(mark[parts], np.cumsum(sizes[partners]) - sizes[partners])
        mark[own] = 0
        linked = partners[100 * both >= percent * (sizes[i] + sizes[partners] - both)]
        if len(linked):
            joined = np.unique(np.concatenate([root[linked], root[[i]]]))
            root[np.isin(root, joined)] = joined[0]
    return root


def _verify(width: int, percent: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, above, below = WordHashes(), [], []
        for group in _groups(batches, ("hub", "one", "two")):
            # In order of the nodes, so that the first set of a component is its smallest node.
            group = group.sort_by("node")
            nodes = np.asarray(group.column("node"))
            sets = [shingle_set(text_words(t), hashes, width) for t in group.column("text").to_pylist()]
            near = possible([x[:k] for x in sets], np.array([len(x) for x in sets]), k)
            apart = _apart(group)
            root = connected(sets, near if apart is None else near & apart, percent)
            moved = np.flatnonzero(root != np.arange(len(root)))
            above += nodes[moved].tolist()
            below += nodes[root[moved]].tolist()
            if len(above) > 20_000:
                yield _pairs(above, below, "u", "v")
                above, below = [], []
        yield _pairs(above, below, "u", "v")
    return run


def _blocked(rows: DataFrame) -> DataFrame:
    """``rows`` of ``hub, node, n_shingles`` with the pairs of blocks they belong to, in the order the tasks need.

    A group of few rows is one block. The blocks of a larger one hold ``BLOCK_ROWS`` rows or ``BLOCK_SHINGLES`` shingles on average.
    """
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int")
    sizes = rows.groupBy("hub").agg(blocks.alias("blocks"), F.count("*").alias("rows")).filter("rows > 1").drop("rows")
    return rows.join(sizes, "hub").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns(
        {"one": F.least("block", "other"), "two": F.greatest("block", "other")}).drop("blocks", "other")


def _tasks(rows: DataFrame) -> DataFrame:
    return rows.repartition("hub", "one", "two").sortWithinPartitions("hub", "one", "two")


def _bit(node: str) -> Column:
    return F.pmod(F.xxhash64(node), F.lit(FILTER_BITS))


def _bitmaps(nodes: DataFrame, name: str) -> DataFrame:
    """The bits of ``nodes`` as at most ``FILTER_BITS / 32768`` rows of 4 KB, combined before they are moved."""
    return nodes.withColumn("h", _bit("node")).groupBy(F.bitmap_bucket_number("h").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias(name))


def _is_set(bitmap: str, h: Column) -> Column:
    at = F.bitmap_bit_position(h)
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.pmod(F.floor(byte / F.element_at(F.array(*(F.lit(1 << i) for i in range(8))), (at % 8 + 1).cast("int"))), F.lit(2)) == 1,
                      F.lit(False))


def _texts(docs: DataFrame, nodes: DataFrame, repeated: DataFrame) -> DataFrame:
    """``node, text`` of all ``nodes`` and a few more: the texts that pass a filter of fixed size, before any of them is moved.

    Ids of several rows have a filter of their own: of these, and of what it passes by chance, each text is taken once.
    """
    filters = _bitmaps(nodes, "likely").join(_bitmaps(nodes.join(repeated, "node", "left_semi"), "again"), "bucket", "left")
    passed = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string").alias("text")).withColumn("h", _bit("node"))
    passed = materialize(passed.join(F.broadcast(filters), F.bitmap_bucket_number("h") == F.col("bucket")).filter(
        _is_set("likely", F.col("h"))).select("node", "text", _is_set("again", F.col("h")).alias("again")), "texts")
    once = passed.filter("again").withColumn("print", text_print(F.col("text"))).dropDuplicates(["node", "print"])
    return passed.filter("not again").select("node", "text").unionByName(once.select("node", "text"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, k: int = SKETCH) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document; extra columns of the input are ignored.

    Documents are linked when 100 * intersection >= ``percent`` * union of their distinct ``width``-word shingles. Texts that are
    null or have no word have no shingles and are linked with nothing. Rows with a null id get a null component and are not
    kept. A repeated row gets the same result as the first; the texts of one id are one document, and each of its rows gets the
    component of its text.
    """
    return judged(docs, width, percent, k).drop("print", "high", "low")


def judged(docs: DataFrame, width: int = 5, percent: int = 80, k: int = SKETCH) -> DataFrame:
    """``near_duplicates`` with ``print`` (digest of the text) and ``high, low`` (fingerprint of its words), which tell the texts of an id apart."""
    if percent < 80:
        raise ValueError("the sketch bounds hold for a similarity of 0.8 or more")
    prefix = k - NEED + 1
    rows = materialize(sketch_table(docs, width, k), "sketches")
    valid = rows.filter("doc_id is not null and n_shingles > 0")
    node_of = valid.groupBy("high", "low").agg(F.min("doc_id").alias("node"))
    nodes = materialize(
        valid.join(node_of.withColumnsRenamed({"high": "h", "low": "l"}),
                   (F.col("high") == F.col("h")) & (F.col("low") == F.col("l")) & (F.col("doc_id") == F.col("node")))
        # A repeated row is one node.
        .groupBy("node", "high", "low").agg(F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"))
        .select("node", "n_shingles", "sketch"), "nodes")

    values = nodes.select("node", "n_shingles", F.explode("sketch").alias("value"))
    lengths = values.groupBy("value").agg(F.count("*").alias("length")).filter("length > 1")
    shared = values.join(lengths, "value").groupBy("node", "n_shingles").agg(
        F.array_sort(F.collect_list(F.struct("length", "value"))).alias("shared"))
    alone = F.least(F.col("n_shingles"), F.lit(k)) - F.size("shared")
    lists = materialize(shared.select(
        "node", F.explode(F.slice("shared", F.lit(1), F.greatest(F.lit(0), F.lit(prefix) - alone).cast("int"))).alias("s")
    ).select("node", "s.value"), "lists")

    heads = lists.groupBy("value").agg(F.min("node").alias("hub"))
    members = materialize(lists.join(heads, "value").select("hub", "node").distinct().join(
        nodes.select("node", "n_shingles"), "node"), "members")
    wide = _tasks(_blocked(members).join(nodes.select("node", "sketch"), "node"))
    likely = materialize(wide.select("hub", "one", "two", "block", "node", "n_shingles", "sketch").mapInArrow(
        _candidates(k), "hub long, node long").distinct(), "likely")
    repeated = rows.filter("doc_id is not null").groupBy(F.col("doc_id").alias("node")).agg(F.count("*").alias("n")).filter("n > 1")
    texts = _texts(docs, likely.select("node"), repeated.select("node"))
    narrow = _blocked(likely.join(nodes.select("node", "n_shingles"), "node"))
    links = _tasks(narrow.join(texts, "node")).select("hub", "one", "two", "block", "node", "text").mapInArrow(
        _verify(width, percent, k), "u long, v long")
    merged = components(links)

    found = node_of.join(merged, "node", "left").select(
        F.col("high").alias("h"), F.col("low").alias("l"), F.coalesce("component", "node").alias("component"))
    joined = rows.join(found, (F.col("high") == F.col("h")) & (F.col("low") == F.col("l")) & (F.col("n_shingles") > 0), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return joined.select("doc_id", "print", "high", "low", "n_shingles", component.alias("component_id"),
                         F.coalesce(component == F.col("doc_id"), F.lit(False)).alias("kept"))
