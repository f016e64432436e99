"""Columns that are computed once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pin(df: DataFrame, **columns: Column) -> DataFrame:
    """Add (or replace) columns whose expressions must not be copied into filters.

    The optimizer moves a filter on a computed column below the projection and
    so evaluates the expression again, once per mention. That is fine for a
    cast and costly for a split line or a built text. A one-element ``inline``
    keeps the values where they are computed, without a shuffle or a write.
    """
    kept = [c for c in df.columns if c not in columns]
    row = F.struct(*[expr.alias(name) for name, expr in columns.items()])
    return df.select(*kept, F.inline(F.array(row)))
