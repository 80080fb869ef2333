"""Mixing sources to target weights as a time-varying curriculum.

Every source has a target in words (its weight's share of a budget, never above twice its size) and a schedule: its weight over the
progress of training, linear between equally spaced knots. The words of a source, in a fixed random order, are its
cumulative demand; the integral of the schedule says what part of the target is due at each progress, so inverting it
gives every copy of a document the progress at which it is trained on. Sorting by that position mixes the sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from roamgrid.llm.shared import WORD_SQL
from roamgrid.session import materialize

WEIGHTS = (3, 1, 2)
# Weights at progress 0, 1/2 and 1 for sources of the weights above: early, level, late.
SCHEDULES = ((2.0, 1.0, 0.5), (1.0, 1.0, 1.0), (0.5, 1.0, 2.0))
BUDGET = 1.5
MOST_COPIES = 2
# Hexadecimal digits of the hash that make a part of a source.
PART_DIGITS = 4


def intervals(knots: tuple[float, ...]) -> list[tuple[float, float, float, float, float]]:
    """``(from share, progress, weight, slope, area)`` of each piece of a schedule; shares are of the whole area."""
    width = 1 / (len(knots) - 1)
    area = sum((a + b) / 2 * width for a, b in zip(knots, knots[1:]))
    if area <= 0 or min(knots) < 0:
        raise ValueError("a schedule needs weights of at least 0, and one above 0")
    out, done = [], 0.0
    for i, (a, b) in enumerate(zip(knots, knots[1:])):
        out.append((done / area, i * width, a, (b - a) / width, area))
        done += (a + b) / 2 * width
    return out


def progress_sql(share: str, schedule: str, schedules=SCHEDULES, mark: str = "D") -> str:
    """SQL for the progress at which a source has consumed ``share`` of its target; ``mark`` follows numbers to make them doubles."""
    def number(x: float) -> str:
        return f"{x!r}{mark}"

    cases = []
    for s, knots in enumerate(schedules):
        for low, start, weight, slope, area in reversed(intervals(knots)):
            rest = f"(({share}) - {number(low)}) * {number(area)}"
            root = f"sqrt({number(weight * weight)} + {number(2 * slope)} * {rest})"
            cases.append(f"WHEN {schedule} = {s} AND ({share}) >= {number(low)} "
                         f"THEN {number(start)} + {number(2.0)} * {rest} / ({number(weight)} + {root})")
    return f"CASE {' '.join(cases)} END"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_SQL)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: int = MOST_COPIES) -> DataFrame:
    """``source, source_size, schedule, target`` from ``source, size`` rows.

    With sources ordered by cap / weight, the ones that reach their cap are a prefix, and the level of the others is the
    largest of what is left per weight left before each source. There is one row per source, so the two windows over all
    of them are small.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = by_source.withColumn("schedule", ((F.row_number().over(W.orderBy(F.asc_nulls_last("source"))) - 1)
                                               % len(weights)).cast("int"))
    ranked = ranked.withColumns({
        "weight": F.element_at(F.array(*map(F.lit, weights)), F.col("schedule") + 1),
        "cap": F.col("source_size") * most})
    everything = W.partitionBy(F.lit(0))
    up_to = everything.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source")).rowsBetween(W.unboundedPreceding, 0)
    cap_before, weight_before = F.sum("cap").over(up_to) - F.col("cap"), F.sum("weight").over(up_to) - F.col("weight")
    level = ((F.sum("source_size").over(everything) * F.lit(float(budget)) - cap_before)
             / (F.sum("weight").over(everything) - weight_before).cast("double"))
    filled = ranked.withColumn("level", level).withColumn("most", F.max("level").over(everything))
    share = F.col("most") * F.col("weight")
    return filled.select("source", "source_size", "schedule",
                         F.when(F.col("cap") <= share, F.col("cap").cast("double")).otherwise(share).alias("target"))


def _sized(docs: DataFrame) -> DataFrame:
    """``docs`` with the key of the order within a source, the part of that order, and what breaks ties."""
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    # A null source differs from every text, so that plain equality joins sources.
    source = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))
    sized = docs.withColumns({"__source": source, "__key": key, "__crc": F.crc32(F.col("text").cast("binary")), "__size": words(F.col("text"))})
    return sized.withColumn("__part", F.substring("__key", 1, PART_DIGITS))


def _offsets(docs: DataFrame, weights, budget: float, most: int) -> DataFrame:
    """A row for each source and part: the words of the source before the part, and what holds for the source."""
    parts = materialize(_sized(docs).groupBy("source", "__source", "__part").agg(F.sum("__size").alias("part_size")), "parts")
    before = F.sum("part_size").over(W.partitionBy("__source").orderBy("__part").rowsBetween(W.unboundedPreceding, 0))
    sources = targets(parts.select("source", F.col("part_size").alias("size")), weights, budget, most)
    sources = sources.withColumn("__s", F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))).drop("source")
    placed = parts.withColumn("__offset", before - F.col("part_size")).join(sources, F.col("__source") == F.col("__s"))
    return placed.select("__s", F.col("__part").alias("__p"), "__offset", F.col("source_size").alias("__source_size"),
                         F.col("schedule").alias("__schedule"), F.col("target").alias("__target"))


def _placed(docs: DataFrame, offsets: DataFrame, schedules, most: int) -> DataFrame:
    """``docs`` with ``__rank`` (in its part), ``__size``, ``__source_size``, ``__target`` and the positions of the copies.

    The window and the join use the same two keys, so a row, and whatever columns ride along, is moved once.
    """
    order = W.partitionBy("__source", "__part").orderBy("__key", "__size", "__crc")
    ranked = _sized(docs).withColumns({
        "__rank": F.row_number().over(order),
        "__inside": F.sum("__size").over(order.rowsBetween(W.unboundedPreceding, 0)) - F.col("__size")})
    # Both sides are partitioned by these keys; a broadcast would be as right, but its size would grow with the sources.
    placed = ranked.join(offsets.hint("merge"), (F.col("__source") == F.col("__s")) & (F.col("__part") == F.col("__p")))
    placed = placed.withColumn("__middle", (F.col("__offset") + F.col("__inside")).cast("double") + F.col("__size") / 2.0)
    middles = [F.col("__middle") + F.lit(float(e)) * F.col("__source_size") for e in range(most)]
    shares = F.array(*[F.when(m < F.col("__target"), m / F.col("__target")) for m in middles])
    positions = F.expr(f"transform(__shares, x -> {progress_sql('x', '__schedule', schedules)})")
    return placed.withColumn("__shares", F.array_compact(shares)).withColumn("__positions", positions).drop(
        "__s", "__p", "__offset", "__inside", "__middle", "__shares", "__schedule")


def curriculum(docs: DataFrame, weights=WEIGHTS, schedules=SCHEDULES, budget: float = BUDGET,
               most: int = MOST_COPIES) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, positions`` of every row: its words, its copies (0 to ``most``) and
    the positions (progress in training, 0 to 1) of the copies as an array; ``part`` and ``rank`` tell rows of a source apart.

    A copy is taken when the middle of its words lies within the target of its source. Null and empty texts have size 0.
    A null source is a source of its own, the last; null ids are allowed. The order within a source is by a hash of
    the id, so reruns agree; equal rows are interchangeable. The prefix sums are taken per (source, part of the hash) and
    shifted by the sums of the parts before, so a source with a third of all rows is spread over 65,536 windows.
    """
    plain = docs.select("doc_id", "source", "text")
    placed = _placed(plain, _offsets(plain, weights, budget, most), schedules, most)
    return _plan(placed)


def _plan(placed: DataFrame) -> DataFrame:
    return placed.select("doc_id", "source", F.col("__source").alias("src"), F.col("__part").alias("part"), F.col("__rank").alias("rank"),
                         F.col("__size").alias("size"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target"),
                         F.size("__positions").alias("copies"), F.col("__positions").alias("positions"))


def _copies(docs: DataFrame, offsets: DataFrame, schedules=SCHEDULES, most: int = MOST_COPIES) -> DataFrame:
    """A row per copy with the columns of ``docs``, what ``_placed`` adds and ``__at``, range-sorted by position.

    A text is moved to its part of its source, and its copies to their range. Rows without a copy stop at the first of these.
    """
    placed = _placed(docs, offsets, schedules, most).filter(F.size("__positions") > 0)
    return placed.withColumn("__at", F.explode("__positions")).orderBy("__at", "__key", "__rank")


def mix(docs: DataFrame, weights=WEIGHTS, schedules=SCHEDULES, budget: float = BUDGET, most: int = MOST_COPIES) -> DataFrame:
    """The documents as they are trained on: a row per copy, all columns of the input, range-sorted by position."""
    copies = _copies(docs, _offsets(docs.select("doc_id", "source", "text"), weights, budget, most), schedules, most)
    return copies.select(*[F.col(f"`{c}`") for c in docs.columns])


def mixed_documents(docs: DataFrame, weights=WEIGHTS, schedules=SCHEDULES, budget: float = BUDGET, most: int = MOST_COPIES) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies, first_position`` of every row; the last three are of its copies in the mix.

    The words are counted in the texts that come out of the range sort. Writing the counts keeps the sort in the plan.
    """
    offsets = materialize(_offsets(docs.select("doc_id", "source", "text"), weights, budget, most), "offsets")
    plan = _plan(_placed(docs.select("doc_id", "source", "text"), offsets, schedules, most)).drop("positions", "copies")
    copies = materialize(_copies(docs, offsets, schedules, most).select(
        F.col("__source").alias("s"), F.col("__part").alias("p"), F.col("__rank").alias("r"), "__at", words(F.col("text")).alias("words")), "copies")
    found = copies.groupBy("s", "p", "r").agg(
        F.sum("words").alias("taken"), F.count("*").cast("int").alias("found"), F.min("__at").alias("first_position"))
    joined = plan.join(found, (F.col("src") == F.col("s")) & (F.col("part") == F.col("p")) & (F.col("rank") == F.col("r")), "left")
    return joined.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
                         F.coalesce("found", F.lit(0)).alias("copies"), "first_position")
