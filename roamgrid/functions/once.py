"""Evaluate expensive columns once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns so that later filters and projections read their result.

    Spark moves a filter below a projection by repeating the expressions it refers to, which would parse a document
    again for every rule and multiplies nested expressions. It does not do so through a generator; this one yields
    exactly one row.
    """
    kept = [F.col(c) for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
