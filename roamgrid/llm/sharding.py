"""A uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

Rows lie in parts (by a hash of the id). In a uniformly random arrangement, the numbers of rows that go from each part to each shard
follow a multivariate hypergeometric law. They are drawn exactly, by inversion of the distribution in SQL, down a binary tree over the
parts: how many rows of every shard come from the left half of a node's parts, then from the halves of each half. Nodes of a level are
independent rows, so they are drawn in as many tasks as there are. Each part is permuted at random and cut by its row of the matrix, rows are exchanged, and each shard is
permuted again. Everything is DataFrame and SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from roamgrid.session import materialize

SHARDS = 24
PART_ROWS = 2_000_000
PART_BYTES = 256 << 20
MIN_PARTS = 64
BLOCKS = 256


def _let(name: str, value: str, body: str) -> str:
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def hypergeometric_sql(pool: str, marked: str, draws: str, uniform: str) -> str:
    """SQL for the number of marked items in ``draws`` without replacement from ``pool`` items, by inversion at ``uniform``.

    Weights start with 1 at the mode and follow from each other by their ratio. Those within 10 deviations (and 30 items) of the mode are
    summed; the rest is below 10^-20.
    """
    mode = "bigint(floor((h.n + 1D) * (h.k + 1D) / (h.pool + 2D)))"
    spread = "bigint(ceil(10D * sqrt(h.n * (h.k / greatest(h.pool, 1D)) * (1D - h.k / greatest(h.pool, 1D))) + 30D))"
    up = "(h.k - i + 1D) * (h.n - i + 1D) / (i * (h.pool - h.k - h.n + i))"
    down = "(i + 1D) * (h.pool - h.k - h.n + i + 1D) / ((h.k - i) * (h.n - i))"
    # The values above and below the mode, from it outwards.
    above = "if(w.high > w.mode, sequence(w.mode + 1, w.high), cast(array() as array<bigint>))"
    below = "if(w.low < w.mode, sequence(w.mode - 1, w.low, -1), cast(array() as array<bigint>))"

    def fold(values: str, ratio: str) -> str:
        step = _let("v", f"a.w * {ratio}", "named_struct('w', v, 's', a.s + v)")
        return f"aggregate({values}, named_struct('w', 1D, 's', 0D), (a, i) -> {step}).s"

    # What is left to pass: upwards until it is used up, downwards while all of a value can be given back.
    climb = (f"aggregate({above}, named_struct('w', 1D, 'left', t.target - t.below - 1D, 'at', w.mode), (a, i) -> "
             + _let("v", f"a.w * {up}", "named_struct('w', v, 'left', a.left - v, 'at', if(a.left > 0D, i, a.at))") + ").at")
    descend = (f"aggregate({below}, named_struct('w', 1D, 'left', t.below - t.target, 'at', w.mode - 1), (a, i) -> "
               + _let("v", f"a.w * {down}", "named_struct('w', v, 'left', a.left - v, 'at', if(a.left - v >= 0D, i - 1, a.at))") + ").at")
    drawn = _let("h", f"named_struct('pool', double({pool}), 'k', double({marked}), 'n', double({draws}), 'u', double({uniform}))", _let(
        "w", f"named_struct('mode', {mode}, 'low', bigint(greatest(0D, h.n - (h.pool - h.k), {mode} - {spread})), "
             f"'high', bigint(least(h.n, h.k, {mode} + {spread})))", _let(
            "s", f"named_struct('below', {fold(below, down)}, 'above', {fold(above, up)})", _let(
                "t", "named_struct('below', s.below, 'target', h.u * (s.below + 1D + s.above))",
                f"greatest(w.low, least(w.high, if(t.target > t.below, {climb}, {descend})))"))))
    return f"if(({draws}) = 0 or ({marked}) = 0, 0L, {drawn})"


def halves_sql(half: str, quotas: str, seed: int) -> str:
    """SQL for how many rows of each quota are drawn when ``half`` rows are taken at random from the rows of all ``quotas``, shard after shard."""
    uniform = f"(pmod(xxhash64(level, node, s, {seed}), 9007199254740992) + 0.5D) / 9007199254740992D"
    draw = hypergeometric_sql("b.pool", f"{quotas}[s]", "b.n", uniform)
    step = _let("d", draw, f"named_struct('n', b.n - d, 'pool', b.pool - {quotas}[s], 'out', concat(b.out, array(d)))")
    start = f"named_struct('n', bigint({half}), 'pool', aggregate({quotas}, 0L, (x, y) -> x + y), 'out', cast(array() as array<bigint>))"
    return f"aggregate(sequence(0, size({quotas}) - 1), {start}, (b, s) -> {step}).out"


def matrix(counts: DataFrame, parts: int, shards: int, seed: int) -> DataFrame:
    """``part, rows``: how many rows of each of ``parts`` go to each shard, from ``part, count``; parts without rows may be missing.

    A level of the tree is written before the next one is drawn: at most one row of ``shards`` numbers for a part.
    """
    spark = counts.sparkSession
    levels = max(0, (parts - 1).bit_length())
    sizes = materialize(counts.filter(F.col("part").isNotNull()).select(F.col("part").cast("long").alias("part"), "count"), "counts")
    total = sizes.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n")).first()["n"]
    quotas = [total // shards + (s < total % shards) for s in range(shards)]
    nodes = spark.range(1).select(F.lit(0).cast("long").alias("node"), F.array(*[F.lit(q).cast("long") for q in quotas]).alias("rows"))
    for level in range(1, levels + 1):
        # The rows below each left child.
        left = sizes.groupBy(F.shiftright("part", levels - level).alias("child")).agg(F.sum("count").alias("half")).filter("child % 2 = 0").select(
            F.expr("child div 2").alias("above"), "half")
        joined = nodes.join(left, F.col("node") == F.col("above"), "left").select(
            F.lit(level).alias("level"), "node", "rows", F.coalesce("half", F.lit(0)).alias("half")).repartition(min(1 << (level - 1), 4096), "node")
        drawn = materialize(joined.select("node", "rows", F.expr(halves_sql("half", "rows", seed)).alias("taken")), "draws")
        nodes = drawn.select(F.expr("""inline(array(named_struct('node', 2 * node, 'rows', taken),
            named_struct('node', 2 * node + 1, 'rows', zip_with(rows, taken, (x, y) -> x - y))))"""))
    return nodes.filter(F.col("node") < parts).select(F.col("node").cast("int").alias("part"), "rows")


def text_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text.cast("string")), F.lit(0)).cast("long") + 8


def _bytes(table: DataFrame) -> Column:
    """About the size of a row: its texts and binary values, also those in a struct, and 8 for every other column."""
    def of(fields, prefix: str) -> list[Column]:
        found = []
        for f in fields:
            at = f"{prefix}`{f.name}`"
            kind = f.dataType.typeName()
            if kind == "struct":
                found += of(f.dataType.fields, at + ".")
            else:
                found.append(F.coalesce(F.octet_length(at).cast("long"), F.lit(0)) if kind in ("string", "binary") else F.lit(8))
        return found

    return sum(of(table.schema.fields, ""), F.lit(0).cast("long"))


def shuffle(rows: DataFrame, shards: int = SHARDS, seed: int = 0, stored: bool = False) -> DataFrame:
    """The input with ``shard`` and ``slot``: a uniform random arrangement, fixed by ``seed``, with shard sizes at most one apart.

    ``rows`` needs ``doc_id``; it is written once, unless it is ``stored`` already and gives equal rows whenever it is read. All its columns are moved
    twice, to the part and to the shard. Null ids share a part. The
    order of rows that are equal in all columns is arbitrary and makes no difference. Slots of a shard are counted per block of
    random keys and shifted by the blocks before, so no task holds a shard.
    """
    every = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    table = rows if stored else materialize(rows, "rows")
    size = table.agg(F.count("*").alias("rows"), F.coalesce(F.sum(_bytes(table)), F.lit(0)).alias("bytes")).first()
    parts = max(MIN_PARTS, -(-size["rows"] // PART_ROWS), -(-size["bytes"] // PART_BYTES))
    blocks = max(BLOCKS, -(-size["bytes"] // (PART_BYTES * shards)), -(-size["rows"] // (PART_ROWS * shards)))
    keyed = table.select(every.alias("row"), F.pmod(F.xxhash64("doc_id", F.lit(seed), F.lit(1)), F.lit(parts)).cast("int").alias("part"),
                         F.xxhash64("doc_id", F.lit(seed), F.lit(2)).alias("key"), F.xxhash64(every, F.lit(3)).alias("tie"))
    numbers = materialize(keyed.drop("row"), "numbers")
    found = numbers.groupBy("part").count()
    sums = "transform(sequence(1, size(rows)), i -> aggregate(slice(rows, 1, i), 0L, (x, y) -> x + y))"
    ends = materialize(matrix(found, parts, shards, seed).select(F.col("part").alias("to_part"), F.expr(sums).alias("ends")), "matrix")

    def sent(some: DataFrame) -> DataFrame:
        local = some.withColumn("at", F.row_number().over(W.partitionBy("part").orderBy("key", "tie")))
        again = F.xxhash64("key", "tie", F.lit(seed), F.lit(4))
        return local.join(ends, F.col("part") == F.col("to_part")).drop("to_part").withColumns({
            "shard": F.expr("size(filter(ends, e -> e < at))"), "again": again,
            "block": F.pmod(again, F.lit(blocks)).cast("int")}).drop("ends", "at", "part", "key")

    # Equal numbers are equal in all that follows, so the sizes of blocks are found without moving the rows.
    sizes = materialize(sent(numbers).groupBy("shard", "block").count(), "sizes")
    before = F.sum("count").over(W.partitionBy("shard").orderBy("block").rowsBetween(W.unboundedPreceding, 0)) - F.col("count")
    offsets = sizes.select(F.col("shard").alias("s"), F.col("block").alias("b"), before.alias("offset"))
    inside = F.row_number().over(W.partitionBy("shard", "block").orderBy("again", "tie")) - 1
    return sent(keyed).withColumn("inside", inside).join(
        offsets, (F.col("shard") == F.col("s")) & (F.col("block") == F.col("b"))).select(
        "row.*", "shard", (F.col("offset") + F.col("inside")).cast("long").alias("slot"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = 0) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every document; null texts count as empty ones.

    Whole documents go to their shards; size and checksum are of the texts that arrive. ``docs`` is read more than once, so it
    must be a stored table.
    """
    whole = docs.select("doc_id", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"))
    text = F.col("document.text").cast("string")
    return shuffle(whole, shards, seed, stored=True).select(
        "doc_id", text_size(text).alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
