"""The prefix trie of conversations that are rebuilt from the head of another one and their own later turns.

Fingerprints of turn sequences form a monoid: a sequence of turns e1 .. en has the value e1 B + e2 B^2 + .. + en B^n modulo a prime, and
the value of two sequences in a row is the first plus B^(length of the first) times the second. Four primes of 31 bits give 124 bits
within longs. The prefixes of every stored conversation are running sums, so any prefix of a rebuilt one is the head's value plus a
shifted difference of two of its own: no rebuilt text is ever written, only numbers move.

Turns are stored once for each different role and text (by SHA-256, and a digest that stands for two contents stops the job); what a
prefix carries of its last turn is a reference to that table. Prefixes of equal depth and fingerprint are one node. All members must refer to
one last turn and have one parent, which by induction from the root proves them equal turn by turn.

Sums over subtrees need no walk by level. Every node belongs to its smallest member, whose own nodes are a tail of its path; so a running
sum along each path, summed over the members of a node, is the sum over its subtree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from roamgrid.llm.positions import numbered, streamed
from roamgrid.llm.shared import WORD_SQL
from roamgrid.session import materialize

GROUP = 20
HEADS = 4
BLOCK = 1024
# The largest primes below 2^31, and a base for each.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
BASES = (1103515245, 1664525, 69069, 214013)
_LANES = range(len(PRIMES))


def _power(base: int, prime: int, exponent: Column, digits: int, radix: int = 32) -> Column:
    """``base`` to a power below ``radix ** digits``, as a product of values from small tables."""
    out = None
    for digit in range(digits):
        step = radix ** digit
        table = F.array(*(F.lit(pow(base, step * i, prime)).cast("long") for i in range(radix)))
        own = F.element_at(table, (F.floor(exponent / step) % radix + 1).cast("int"))
        out = own if out is None else out * own % prime
    return out


def _shifted(lane: int, value: Column, by: Column, most: int) -> Column:
    """``value`` times the base to the power ``by``, which lies between ``-most`` and 0."""
    prime = PRIMES[lane]
    table = F.array(*(F.lit(pow(pow(BASES[lane], i, prime), -1, prime)).cast("long") for i in range(most + 1)))
    return value * F.element_at(table, (1 - by).cast("int")) % prime


def stored_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, at, print, words``: the turns in order with a reference to their content, and the words of the text.

    The table of contents has a row for each different (role, text); a print of two contents is an error, not a merge.
    """
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # The length of the role keeps role and text apart.
    content = F.concat_ws(":", F.length("role").cast("string"), "role", "text")
    rows = rows.withColumns({"print": F.unhex(F.sha2(content, 256)), "words": F.regexp_count("text", F.lit(WORD_SQL)).cast("long")})
    stored = rows.groupBy("print", "role", "text").agg(F.count("*").alias("n")).groupBy("print").agg(F.count("*").alias("contents"))
    if stored.filter("contents > 1").limit(1).count():
        raise ValueError("two different turns have one digest")
    narrow = materialize(rows.select("conv_id", "turn", "role", "print", "words").withColumn("row", F.monotonically_increasing_id()), "turns")
    order = [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("print").asc(), F.col("row").asc()]
    return numbered(narrow, "conv_id", order).select("conv_id", "at", "print", "words")


def _running(rows: DataFrame, group: str, position: str, sums: dict[str, Column], block: int = BLOCK) -> DataFrame:
    """``rows`` with running sums by position (from 1, no gaps), taken in blocks so that no window holds a whole group."""
    cut = F.floor((F.col(position) - 1) / block).cast("long")
    order = W.partitionBy(group, "__block").orderBy(position).rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("__block", cut)
    blocks = rows.groupBy(F.col(group).alias("__g"), F.col("__block").alias("__b")).agg(*(F.sum(c).alias(f"__s_{n}") for n, c in sums.items()))
    past = W.partitionBy("__g").orderBy("__b").rowsBetween(W.unboundedPreceding, -1)
    before = blocks.select("__g", "__b", *(F.sum(f"__s_{n}").over(past).alias(f"__s_{n}") for n in sums)).filter("__b > 0")
    inside = rows.withColumns({n: F.sum(c).over(order) for n, c in sums.items()})
    joined = inside.join(before, (F.col(group) == F.col("__g")) & (F.col("__block") == F.col("__b")), "left")
    return joined.withColumns({n: F.col(n) + F.coalesce(f"__s_{n}", F.lit(0)) for n in sums}).drop(
        "__block", "__g", "__b", *(f"__s_{n}" for n in sums))


def fingerprinted(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """``turns`` with ``s``: for each prime the value of the turns up to this one."""
    # The power of a position is that of its place in a block times that of the blocks before, which is 1 in most conversations.
    place, cut = (F.col("at") - 1) % BLOCK + 1, F.floor((F.col("at") - 1) / BLOCK)
    terms = []
    for lane, (prime, base) in enumerate(zip(PRIMES, BASES)):
        code = F.conv(F.substring(F.hex("print"), 1 + 8 * lane, 8), 16, 10).cast("long") % prime
        blocks = F.when(cut == 0, F.lit(1).cast("long")).otherwise(_power(pow(base, BLOCK, prime), prime, cut, digits=8))
        terms.append(code * _power(base, prime, place, digits=3) % prime * blocks % prime)
    # A term is below 2^31, so 2^32 of them fit into a long.
    summed = _running(turns.withColumns({f"t{i}": terms[i] for i in _LANES}), "conv_id", "at",
                      {f"s{i}": F.col(f"t{i}") for i in _LANES}, block)
    return summed.select("conv_id", "at", "print", "words", F.array(*(F.col(f"s{i}") % PRIMES[i] for i in _LANES)).alias("s"))


def _paths(turns: DataFrame, group: int, heads: int) -> tuple[DataFrame, DataFrame]:
    """``conv_id, depth, s, print, words`` of every prefix of every rebuilt conversation, and ``conv_id, length`` of all of them.

    A rebuilt conversation is the first ``h`` turns of the conversation at the start of its group, then its own after its first ``h``.
    """
    ids = turns.groupBy("conv_id").agg(F.max("at").alias("own")).withColumns({
        "h": (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("long"),
        "base": F.col("conv_id") - F.col("conv_id") % group})
    most = heads - 1
    tops = turns.filter(F.col("at") <= most).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("at", "s", "print", "words"))).alias("top"))
    zero = F.array(*(F.lit(0).cast("long") for _ in _LANES))
    plans = ids.join(tops.select(F.col("conv_id").alias("base"), F.col("top").alias("base_top")), "base", "left").join(
        tops.withColumnRenamed("top", "own_top"), "conv_id", "left")
    head = F.slice(F.coalesce("base_top", F.expr("array()").cast(tops.schema["top"].dataType)), F.lit(1), F.col("h").cast("int"))
    plans = materialize(plans.withColumn("head", head).withColumn("n_head", F.size("head").cast("long")).select(
        "conv_id", "own", "h", "head", "n_head", (F.col("n_head") + F.greatest(F.lit(0), F.col("own") - F.col("h"))).alias("length"),
        F.when(F.col("n_head") > 0, F.element_at("head.s", F.greatest(F.col("n_head").cast("int"), F.lit(1)))).otherwise(zero).alias("head_s"),
        F.when(F.least("h", "own") > 0, F.element_at("own_top.s", F.greatest(F.least("h", "own").cast("int"), F.lit(1)))).otherwise(
            zero).alias("cut_s")), "plans")
    first = plans.select("conv_id", F.explode("head").alias("x")).select(
        "conv_id", F.col("x.at").alias("depth"), "x.s", "x.print", "x.words")
    # Only numbers of a conversation are joined to its turns; one with very many turns is split by the skew join.
    own = turns.join(plans.select("conv_id", "h", "n_head", "head_s", "cut_s"), "conv_id").filter("at > h")
    value = F.array(*((F.col("head_s")[i] + _shifted(i, (F.col("s")[i] - F.col("cut_s")[i] + PRIMES[i]) % PRIMES[i],
                                                   F.col("n_head") - F.col("h"), most)) % PRIMES[i] for i in _LANES))
    own = own.select("conv_id", (F.col("at") - F.col("h") + F.col("n_head")).alias("depth"), value.alias("s"), "print", "words")
    return first.unionByName(own), plans.select("conv_id", "length", "n_head", "h", "head_s", "cut_s")


def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ids of each node, which come one by one in their order."""
    node, digest = None, None
    for batch in batches:
        nodes, digests = [], []
        for n, conv in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()):
            if n != node:
                if digest:
                    nodes.append(node)
                    digests.append(digest.hexdigest())
                node, digest = n, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(str(conv).encode())
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(digests, pa.string())], names=["n", "ends_sha256"])
    if digest:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()])], names=["n", "ends_sha256"])


def prefix_trie(conversations: DataFrame, group: int = GROUP, heads: int = HEADS, block: int = BLOCK) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`` of every node.

    Turns are taken by ``turn`` (nulls first), then by role and by the digest of role and text, then as stored; a repeated row is a turn of
    its own. Null roles and texts are empty. Rows without a ``conv_id`` belong to no conversation and are left out; extra columns are
    ignored. An empty table has no conversation, hence no node.
    """
    turns = materialize(fingerprinted(stored_turns(conversations), block), "stored")
    paths, plans = _paths(turns, group, heads)
    # A node's name: depth and fingerprint. The root is the empty sequence.
    name = F.unhex(F.concat(F.lpad(F.hex("depth"), 16, "0"), *(F.lpad(F.hex(F.col("s")[i]), 8, "0") for i in _LANES)))
    root = F.unhex(F.lit("0" * (16 + 8 * len(PRIMES))))
    # The fingerprint without the last turn is that of the parent.
    paths = materialize(paths.withColumn("node", name), "paths")
    before = paths.select(F.col("conv_id").alias("c"), (F.col("depth") + 1).alias("d"), F.col("node").alias("above"))
    steps = paths.select("conv_id", "depth", "node", "print", "words").join(
        before, (F.col("conv_id") == F.col("c")) & (F.col("depth") == F.col("d")), "left").select(
        "conv_id", "depth", "node", "print", "words", F.coalesce("above", root).alias("above"))
    steps = materialize(steps.unionByName(plans.select(
        "conv_id", F.lit(0).cast("long").alias("depth"), root.alias("node"), F.lit(None).cast("binary").alias("print"),
        F.lit(0).cast("long").alias("words"), F.lit(None).cast("binary").alias("above"))), "steps")

    nodes = steps.groupBy("node").agg(
        F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words"),
        F.min("above").alias("above"),
        ((F.min("print") != F.max("print")) | (F.min("above") != F.max("above")) | (F.min("depth") != F.max("depth"))).alias("differ"))
    children = nodes.groupBy(F.col("above").alias("a")).agg(F.count("*").alias("n_children"))
    nodes = materialize(nodes.join(children, F.col("node") == F.col("a"), "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0))).drop("a"), "nodes")
    if nodes.filter("differ").limit(1).count():
        raise ValueError("two different prefixes have one fingerprint; choose other bases")

    # Each node at the place of its smallest member: what it saves, and whether it is a leaf.
    owned = nodes.select(F.col("conv_id").alias("c"), F.col("depth").alias("d"), ((F.col("n_convs") - 1) * F.col("words")).alias("saves"),
                         (F.col("n_children") == 0).cast("long").alias("leaf"))
    placed = steps.select("conv_id", "depth", "node").join(
        owned, (F.col("conv_id") == F.col("c")) & (F.col("depth") == F.col("d")), "left").select(
        "conv_id", (F.col("depth") + 1).alias("step"), "node", F.coalesce("saves", F.lit(0)).alias("saves"),
        F.coalesce("leaf", F.lit(0)).alias("leaf"))
    placed = materialize(placed, "placed")
    whole = placed.groupBy(F.col("conv_id").alias("c")).agg(F.sum("saves").alias("all_saves"), F.sum("leaf").alias("all_leaves"))
    run = _running(placed, "conv_id", "step", {"run_saves": F.col("saves"), "run_leaves": F.col("leaf")}, block)
    # A sum over a tail is the whole sum less the running sum, plus the place itself.
    totals = run.join(whole, F.col("conv_id") == F.col("c")).groupBy(F.col("node").alias("t")).agg(
        F.sum(F.col("all_saves") - F.col("run_saves") + F.col("saves")).alias("saved_tokens"),
        F.sum(F.col("all_leaves") - F.col("run_leaves") + F.col("leaf")).alias("n_leaves"))

    last = steps.select(F.col("conv_id"), F.col("depth"), "node").join(
        plans.select(F.col("conv_id").alias("c"), F.col("length").alias("d")), (F.col("conv_id") == F.col("c")) & (F.col("depth") == F.col("d")))
    ends = streamed(last.select("node", "conv_id"), "node", "conv_id", by="node").mapInArrow(_digest_rows, "n binary, ends_sha256 string")
    parents = nodes.select(F.col("node").alias("p"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(parents, F.col("above") == F.col("p"), "left").join(totals, F.col("node") == F.col("t")).join(
        ends, F.col("node") == F.col("n"), "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
