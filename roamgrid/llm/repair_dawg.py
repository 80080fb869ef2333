"""Repair of the structure of conversations: the cheapest edits that make the roles alternate, over a suffix-shared automaton.

A turn is one letter: its role's initial (capital if the text is truncated), or ``x`` if it has to go. The letters of a conversation are its
signature, cut into segments of bounded length. All segments are sorted by what follows them and by their reversed letters, so
segments with a common suffix stand side by side: the automaton is built from the end, only what lies before the shared suffix
makes new nodes, and a conversation whose signature occurred before makes none. A node holds, for each state of the role grammar, the
cost to go and the first edit of the best audit suffix; the rest of that audit is read off the nodes after it. Costs less
their minimum take few different values whatever the length, so nodes are registered by them and by the letter: that minimal automaton
is worked out once per process.

What follows a segment is the cost to go at the start of the next one. A segment acts on it as a 4 x 4 matrix of costs (minimum for
sum, sum for product), so conversations of many segments need one pass over a matrix for each segment, not over turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from roamgrid.llm.positions import numbered, streamed
from roamgrid.session import materialize

SEGMENT = 1024
BLANK = r"[^\x20\x09-\x0D]"

# States of the grammar (s?(ua)+)?: nothing yet, after s, after u, after a. The first and the last may end.
STATES = 4
_KEEP = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
# The state after the one role that may be inserted, or given to a turn, in each state.
_NEXT = (2, 2, 3, 2)
_ROLE = {2: "user", 3: "assistant"}
# Costs and edits at the end of a conversation.
END = (0, 4, 2, 0)
_CLOSE = ("", "II", "I", "")
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
_NEVER = 1 << 40


class Automaton(dict):
    """``(letter, costs after it) -> (shift, costs before it, first edits)`` by state; costs are less ``shift``, their minimum."""

    def __missing__(self, key: tuple[str, tuple[int, ...]]):
        letter, after = key
        ways: list[dict[str, int]] = [{"D": DELETE + after[q]} for q in range(STATES)]
        if letter != "x":
            extra = TRUNCATED if letter.isupper() else 0
            for q, way in enumerate(ways):
                way["R"] = REROLE + extra + after[_NEXT[q]]
                kept = _KEEP.get(letter.lower(), {}).get(q)
                if kept is not None:
                    way["K"] = extra + after[kept]
        costs = [min(way.values()) for way in ways]
        for _ in range(STATES):
            costs = [min(c, INSERT + costs[_NEXT[q]]) for q, c in enumerate(costs)]
        for q, way in enumerate(ways):
            way["I"] = INSERT + costs[_NEXT[q]]
        # Equal costs: the first edit decides, since no two edits of one state share an initial.
        edits = "".join(min((c, e) for e, c in way.items())[1] for way in ways)
        shift, before = _normal(costs)
        value = self[key] = shift, before, edits
        return value


def _normal(costs: list[int]) -> tuple[int, tuple[int, ...]]:
    """The minimum of ``costs``, and what they are above it."""
    least = min(costs)
    return least, tuple(c - least if c < _NEVER else _NEVER for c in costs)


class Suffixes:
    """The nodes on the path of the last signature, from the end; a signature with a common suffix shares its nodes."""

    def __init__(self, automaton: Automaton):
        self.automaton, self.end, self.letters, self.nodes, self.made = automaton, None, "", [], 0

    def insert(self, letters: str, end: tuple[int, ...]) -> None:
        back = letters[::-1]
        if end != self.end:
            self.end, self.letters, self.nodes = end, "", [(0, end, "")]
        shared = 0
        for a, b in zip(back, self.letters):
            if a != b:
                break
            shared += 1
        del self.nodes[shared + 1:]
        total, costs, _ = self.nodes[-1]
        for letter in back[shared:]:
            shift, costs, edits = self.automaton[letter, costs]
            total += shift
            self.nodes.append((total, costs, edits))
            self.made += 1
        self.letters = back

    def cost(self, state: int) -> int:
        return self.nodes[-1][0] + self.nodes[-1][1][state]

    def audit(self, state: int) -> tuple[str, int]:
        """The best edits of the last signature from ``state``, and the state after them."""
        out, at = [], len(self.nodes) - 1
        while at:
            edit = self.nodes[at][2][state]
            out.append(edit)
            if edit in "IR":
                state = _NEXT[state]
            elif edit == "K":
                state = _KEEP[self.letters[at - 1].lower()][state]
            at -= edit != "I"
        return "".join(out), state


def best_edits(letters: str) -> tuple[int, str]:
    """Cost and audit of one whole signature."""
    path = Suffixes(Automaton())
    path.insert(letters, END)
    audit, state = path.audit(0)
    return path.cost(0), audit + _CLOSE[state]


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    path = Suffixes(Automaton())
    units = [tuple(0 if p == q else _NEVER for p in range(STATES)) for q in range(STATES)]
    for batch in batches:
        out = []
        for letters in batch.column("letters").to_pylist():
            columns = []
            for unit in units:
                path.insert(letters, unit)
                columns.append([min(path.cost(q), _NEVER) for q in range(STATES)])
            out.append([columns[p][q] for q in range(STATES) for p in range(STATES)])
        yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("seg"), pa.array(out, pa.list_(pa.int64()))],
                                         names=["conv", "seg", "matrix"])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the last segment of a conversation to its first: the costs after each."""
    conv, costs = None, END
    for batch in batches:
        ends = []
        for c, matrix in zip(batch.column("conv").to_pylist(), batch.column("matrix").to_pylist()):
            if c != conv:
                conv, costs = c, END
            ends.append(list(costs))
            costs = _normal([min(matrix[q * STATES + p] + costs[p] for p in range(STATES)) for q in range(STATES)])[1]
        yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("seg"), pa.array(ends, pa.list_(pa.int64()))],
                                         names=["conv", "seg", "end"])


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    path = Suffixes(Automaton())
    for batch in batches:
        audits, states, costs = [], [], []
        for letters, end, several in zip(*(batch.column(c).to_pylist() for c in ("letters", "end", "several"))):
            path.insert(letters, tuple(end))
            best = [path.audit(q) if q == 0 or several and path.cost(q) < _NEVER else ("", 0) for q in range(STATES if several else 1)]
            audits.append([a for a, _ in best])
            states.append([s for _, s in best])
            costs.append(path.cost(0))
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), batch.column("seg"), batch.column("letters"), pa.array(audits, pa.list_(pa.string())),
             pa.array(states, pa.list_(pa.int32())), batch.column("last")], names=["conv", "seg", "letters", "audits", "states", "last"])


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the first segment to the last: the audit from the state in which a segment starts, its cost, the turns put out before."""
    conv, state, out = None, 0, 0
    for batch in batches:
        rows: list[tuple] = []
        for c, seg, letters, audits, states, last in zip(*(batch.column(n).to_pylist() for n in batch.schema.names)):
            if c != conv:
                conv, state, out = c, 0, 0
            audit = audits[state]
            start, before = state, out
            state = states[state]
            if last:
                audit += _CLOSE[state]
            out += len(audit) - audit.count("D")
            rows.append((c, seg, letters, audit, start, before, _cost(letters, audit)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(zip(*rows) if rows else [[]] * 7, (
                pa.string(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()))],
            names=["conv", "seg", "letters", "audit", "start", "before", "cost"])


def _cost(letters: str, audit: str) -> int:
    """The cost of an audit; every edit but an insertion takes the next letter."""
    cost, at = 0, 0
    for edit in audit:
        if edit == "I":
            cost += INSERT
            continue
        cost += {"D": DELETE, "R": REROLE, "K": 0}[edit] + (TRUNCATED if edit != "D" and letters[at].isupper() else 0)
        at += 1
    return cost


def _edits(segment: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            convs, ats, outs, roles = [], [], [], []
            for conv, seg, letters, audit, state, out, _ in zip(*(batch.column(n).to_pylist() for n in batch.schema.names)):
                at = 0
                for edit in audit:
                    if edit != "D":
                        state = _KEEP[letters[at].lower()][state] if edit == "K" else _NEXT[state]
                        convs.append(conv)
                        ats.append(None if edit == "I" else seg * segment + at + 1)
                        outs.append(out)
                        roles.append(None if edit == "K" else _ROLE[state])
                        out += 1
                    at += edit != "I"
                if len(convs) > 50_000:
                    yield _edit_rows(convs, ats, outs, roles)
                    convs, ats, outs, roles = [], [], [], []
            yield _edit_rows(convs, ats, outs, roles)
    return run


def _edit_rows(convs: list, ats: list, outs: list, roles: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(convs, pa.string()), pa.array(ats, pa.int64()), pa.array(outs, pa.int64()),
                                       pa.array(roles, pa.string())], names=["c", "a", "out", "new_role"])


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with planted faults, chosen by a checksum of conversation and turn; nulls count as one space."""
    plain = conversations.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    kind = F.crc32(F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))).cast("binary")) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return plain.withColumn("kind", kind).filter("kind != 0").withColumns(
        {"text": text, "role": F.when(F.col("kind") == 4, "user").otherwise(F.col("role")),
         "copy": F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))}).drop("kind", "copy")


class Repair:
    """The repair of ``conv_id, turn, role, text`` rows; extra columns are ignored.

    Turns are taken by ``turn`` (nulls first), then by role and the SHA-256 of the text; null roles and texts count as one space. A null
    ``conv_id`` is a conversation of its own. A turn whose role and text occurred before in its conversation is a duplicate, so of
    repeated rows the first one counts. ``report`` has a row for each conversation that has turns, ``turns`` the repaired turns.
    Conversations of any length are cut into segments; only the audit, which is one value, takes a row of their length.
    """

    def __init__(self, conversations: DataFrame, segment: int = SEGMENT):
        self.segment = segment
        key = F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("n")).alias("conv")
        self.rows = materialize(conversations.select(
            key, "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text")).withColumn("row", F.monotonically_increasing_id()), "turns")
        role = F.substring("role", 1, 1)
        narrow = self.rows.select(
            "conv", "turn", "role", F.sha2("text", 256).alias("print"), "row",
            F.when(role.isin("s", "u", "a"), role).otherwise("o").alias("initial"),
            (~F.col("text").rlike(BLANK)).alias("blank"), F.col("text").rlike(r"[^\x20\x09-\x0D.!?][\x20\x09-\x0D]*\z").alias("cut"))
        order = [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("print").asc(), F.col("row").asc()]
        placed = materialize(numbered(narrow, "conv", order), "placed")
        first = placed.groupBy("conv", "role", "print").agg(F.min("at").alias("at")).select(
            F.col("conv").alias("c"), F.col("at").alias("a"), F.lit(True).alias("first"))
        marked = placed.select("conv", "turn", "at", "row", "initial", "blank", "cut").join(
            first, (F.col("conv") == F.col("c")) & (F.col("at") == F.col("a")), "left")
        fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("cut"), "truncated")
        marked = marked.select("conv", "turn", "at", "row", "initial", fault.alias("fault"))
        letter = F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper("initial")).otherwise(
            F.col("initial"))
        self.marked = materialize(marked.withColumn("letter", letter), "marked")
        self.segments = materialize(self._segments(), "segments")
        self.audits = materialize(self._audited(), "audits")

    def _segments(self) -> DataFrame:
        """``conv, seg, letters, initials, last``: at most ``segment`` turns each."""
        signs = F.array_sort(F.collect_list(F.struct("at", "letter", "initial")))
        rows = self.marked.groupBy("conv", F.floor((F.col("at") - 1) / self.segment).cast("long").alias("seg")).agg(signs.alias("signs"))
        rows = rows.select("conv", "seg", F.array_join("signs.letter", "").alias("letters"),
                           F.array_join("signs.initial", "").alias("initials"))
        ends = W.partitionBy("conv").orderBy("seg")
        return rows.withColumns({"last": F.lead("seg").over(ends).isNull(),
                                 "ahead": F.substring(F.lead("initials").over(ends), 1, 1)})

    def _audited(self) -> DataFrame:
        """``conv, seg, letters, audit, start, before, cost``: the best edits of every segment."""
        several = ~F.col("last") | (F.col("seg") > 0)
        single = self.segments.filter(~several).withColumn("end", F.array(*map(F.lit, END)).cast("array<long>"))
        many = self.segments.filter(several)
        matrices = many.select("conv", "seg", "letters").mapInArrow(_matrices, "conv string, seg long, matrix array<long>")
        ends = streamed(matrices, "conv", F.desc("seg"), by="conv").mapInArrow(_ends, "conv string, seg long, end array<long>")
        many = many.join(ends, ["conv", "seg"])
        columns = ["conv", "seg", "letters", "end", "several", "last"]
        every = single.withColumn("several", F.lit(False)).select(*columns).unionByName(many.withColumn("several", F.lit(True)).select(*columns))
        # Equal signatures may be a third of all; the conversation in the sort key deals them over partitions.
        keys = ("end", F.reverse("letters"), "conv")
        audits = every.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(
            _audits, "conv string, seg long, letters string, audits array<string>, states array<int>, last boolean")
        return streamed(audits, "conv", "seg", by="conv").mapInArrow(
            _chosen, "conv string, seg long, letters string, audit string, start int, before long, cost long")

    @property
    def turns(self) -> DataFrame:
        """``conv, out, role, text``: the repaired turns in the order of ``out``; ``conv`` is the key of ``report``."""
        edits = materialize(self.audits.mapInArrow(_edits(self.segment), "c string, a long, out long, new_role string"), "edits")
        kept = edits.filter("a is not null").join(
            self.marked.select("conv", "at", "row"), (F.col("c") == F.col("conv")) & (F.col("a") == F.col("at"))).select(
            "conv", "out", "new_role", F.col("row").alias("r"))
        kept = kept.join(self.rows.select("row", "role", "text"), F.col("r") == F.col("row")).select(
            "conv", "out", F.coalesce("new_role", "role").alias("role"), "text")
        return kept.unionByName(edits.filter("a is null").select(
            F.col("c").alias("conv"), "out", F.col("new_role").alias("role"), F.lit("").alias("text")))

    @property
    def report(self) -> DataFrame:
        """``conv, gaps, blank, duplicate, truncated, illegal, cost, audit`` of every conversation that has turns."""
        counts = self.marked.groupBy("conv", "turn").agg(*(F.count_if(F.col("fault") == f).alias(f) for f in (
            "blank", "duplicate", "truncated"))).groupBy("conv").agg(
            F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"),
            *(F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")))
        chain = F.concat("initials", F.coalesce("ahead", F.lit("")))
        pairs = F.greatest(F.length(chain) - 1, F.lit(0))
        # Legal pairs may overlap ("uau"), so they are counted by a look at the letter after.
        legal = F.regexp_count(chain, F.lit("s(?=u)|u(?=a)|a(?=u)"))
        illegal = self.segments.groupBy("conv").agg(F.sum(pairs - legal).cast("long").alias("illegal"))
        edits = self.audits.groupBy("conv").agg(F.sum("cost").alias("cost"), F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("seg", "audit"))), lambda x: x["audit"]), "").alias("audit"))
        return counts.join(illegal, "conv").join(edits, "conv")


def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, digest = None, None
    for batch in batches:
        convs, digests = [], []
        for c, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv", "role", "text"))):
            if c != conv:
                if digest:
                    convs.append(conv)
                    digests.append(digest.hexdigest())
                conv, digest = c, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
        yield pa.RecordBatch.from_arrays([pa.array(convs, pa.string()), pa.array(digests, pa.string())], names=["c", "repaired_sha256"])
    if digest:
        yield pa.RecordBatch.from_arrays([pa.array([conv]), pa.array([digest.hexdigest()])], names=["c", "repaired_sha256"])


def digests(turns: DataFrame) -> DataFrame:
    """``c, repaired_sha256``: the digest of the turns of each conversation, which are read one by one in their order."""
    return streamed(turns, "conv", "out", by="conv").mapInArrow(_digest_rows, "c string, repaired_sha256 string")


def damage_and_repair(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """A row for every ``conv_id`` of the input, null included: faults after the damage, cost and audit of the repair, its digest."""
    repair = Repair(damaged(conversations), segment)
    every = conversations.select("conv_id").distinct().withColumn(
        "conv", F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("n")))
    done = every.join(repair.report, "conv", "left").join(digests(repair.turns), F.col("conv") == F.col("c"), "left")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return done.select("conv_id", *(F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in numbers),
                       F.coalesce("audit", F.lit("")).alias("audit"),
                       F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
