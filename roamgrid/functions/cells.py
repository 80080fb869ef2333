"""Fixed-degree grid cells (P12-P15) and exact small-domain distinct counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roamgrid.schemas import GRID_DEG


def with_cell(df: DataFrame, deg: float = GRID_DEG) -> DataFrame:
    """Add ``cx, cy``. The coordinate is divided by the step: multiplying by its inverse moves cell edges."""
    return df.withColumns({"cx": F.floor(F.col("lng") / F.lit(deg)), "cy": F.floor(F.col("lat") / F.lit(deg))})


def cell_id(cx: str | Column = "cx", cy: str | Column = "cy") -> Column:
    return F.concat_ws("_", cx, cy)


def cell_center(df: DataFrame, deg: float = GRID_DEG) -> DataFrame:
    """Add the cell centre ``lng_c, lat_c`` and the same centre as a GeoJSON point."""
    centred = df.withColumns({
        "lng_c": F.round((F.col("cx") + 0.5) * deg, 6),
        "lat_c": F.round((F.col("cy") + 0.5) * deg, 6),
    })
    return centred.withColumn("location", to_point("lng_c", "lat_c"))


def to_point(lng: str | Column, lat: str | Column) -> Column:
    """GeoJSON point: the order is longitude, latitude."""
    return F.struct(F.lit("Point").alias("type"), F.array(lng, lat).alias("coordinates"))


def cell_polygon(lng_c: str = "lng_c", lat_c: str = "lat_c", deg: float = GRID_DEG) -> Column:
    """The square of a cell around its centre as one closed ring, 6 decimals."""
    half = deg / 2
    west, east = F.round(F.col(lng_c) - half, 6), F.round(F.col(lng_c) + half, 6)
    south, north = F.round(F.col(lat_c) - half, 6), F.round(F.col(lat_c) + half, 6)
    corners = [(west, south), (east, south), (east, north), (west, north), (west, south)]
    return F.array(F.array(*[F.struct(x.alias("lng"), y.alias("lat")) for x, y in corners]))


def degree_cell(lng: Column, lat: Column) -> Column:
    """One-degree cell as ``lat,lng`` text."""
    return F.concat_ws(",", F.floor(lat), F.floor(lng))


# An id from 0 to 191 is one bit of three longs. The sets merge with bit_or in fixed-width hash-aggregate buffers, so an
# exact distinct count needs neither the row expansion of count(distinct) nor a second shuffle by id. Other ids are counted
# apart by ``with_species_count`` and added.
_WORDS = 3


def _bitless(species: Column) -> Column:
    return (species < 0) | (species >= 64 * _WORDS)


def species_bits(species: Column) -> list[Column]:
    """Row-level set words of one species id; an id outside 0..191 sets no bit."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), species.cast("int"))
    words = [F.when((species >= 64 * w) & (species < 64 * (w + 1)), bit).otherwise(F.lit(0).cast("long"))
             for w in range(_WORDS)]
    return [w.alias(f"_s{i}") for i, w in enumerate(words)]


def species_chunk(species: Column) -> Column:
    """The number of the chunk of 192 ids that an id is in; ids of one chunk share their words."""
    return F.floor(species / (64 * _WORDS)).cast("long")


def chunk_bits(species: Column) -> list[Column]:
    """Row-level set words of an id within its chunk; a null id sets no bit."""
    return species_bits(F.pmod(species, F.lit(64 * _WORDS)))


def merge_bits(words: list[Column] | None = None) -> list[Column]:
    """Aggregates that union the set words of a group."""
    words = words or [F.col(f"_s{i}") for i in range(_WORDS)]
    return [F.bit_or(w).alias(f"_s{i}") for i, w in enumerate(words)]


def count_bits() -> Column:
    """Number of distinct ids in the merged words."""
    total = F.bit_count("_s0")
    for i in range(1, _WORDS):
        total = total + F.bit_count(f"_s{i}")
    return total.cast("long")


def with_species_count(groups: DataFrame, rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``groups`` (``keys`` and merged words) with the exact number of distinct ids of ``rows`` in each.

    The ids without a bit are read by a filter on ``species_id``, which files answer by their statistics where there are none;
    they are combined per group and id before they are counted.
    """
    found = rows.filter(_bitless(F.col("species_id"))).groupBy(*keys, "species_id").agg(F.lit(1).alias("_one"))
    others = found.groupBy(*keys).agg(F.count(F.lit(1)).alias("_others")).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_others")
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    joined = groups.join(others, same, "left").withColumn(name, count_bits() + F.coalesce("_others", F.lit(0)))
    return joined.drop("_others", *[f"_k{i}" for i in range(len(keys))], *[f"_s{i}" for i in range(_WORDS)])


CURVE_BITS = 20
_SPREAD = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555))


def _spread(number: Column) -> Column:
    """The bits of a number below 2^32 at every second place."""
    for shift, mask in _SPREAD:
        number = number.bitwiseOR(F.shiftleft(number, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return number


def curve_key(lng: str | Column = "lng", lat: str | Column = "lat") -> Column:
    """Place on a Z-order curve over the globe: 2^20 steps a side, so that points of a small box have few ranges of keys."""
    lng, lat = (F.col(c) if isinstance(c, str) else c for c in (lng, lat))
    steps = 1 << CURVE_BITS

    def step(share: Column) -> Column:
        return F.least(F.greatest(F.floor(share * steps), F.lit(0)), F.lit(steps - 1)).cast("long")

    return _spread(step((lng + 180) / 360)).bitwiseOR(F.shiftleft(_spread(step((lat + 90) / 180)), 1))


def with_curve(df: DataFrame, deg: float = GRID_DEG) -> DataFrame:
    """``df`` with the cell ``cx, cy`` and the curve place ``_curve`` of its centre: rows of one cell stay together."""
    placed = with_cell(df, deg)
    return placed.withColumn("_curve", curve_key((F.col("cx") + 0.5) * deg, (F.col("cy") + 0.5) * deg))
