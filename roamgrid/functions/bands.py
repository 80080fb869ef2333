"""Bands of the repetition profile."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Band labels in display order.
GAP_BANDS = ["<=15min", "15min-1h", "1h-24h", "1-7d", ">7d"]
VISIT_BANDS = ["1", "2", "3-5", "6-10", "11-50", ">50"]

_GAP_UPPER_S = [900, 3600, 86_400, 604_800]
_VISIT_UPPER = [1, 2, 5, 10, 50]


def _band(value: Column, upper: list[int], labels: list[str]) -> Column:
    band = F.when(value <= upper[0], labels[0])
    for bound, label in zip(upper[1:], labels[1:]):
        band = band.when(value <= bound, label)
    return band.otherwise(labels[-1])


def gap_band(gap_s: Column) -> Column:
    """Band of a gap in whole seconds; the upper bound belongs to the band."""
    return _band(gap_s, _GAP_UPPER_S, GAP_BANDS)


def visits_band(visits: Column) -> Column:
    return _band(visits, _VISIT_UPPER, VISIT_BANDS)


def point_key(lng: Column, lat: Column) -> Column:
    """Exact point: both coordinates in whole millionths of a degree."""
    return F.struct(*[F.rint(c * 1_000_000).cast("long").alias(n) for n, c in (("x", lng), ("y", lat))])
