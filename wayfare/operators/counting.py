"""Conditional aggregations: many period figures from one scan and one shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_where(df: DataFrame, keys: list[str], measures: dict[str, Column]) -> DataFrame:
    """``count_if`` per measure; without keys one total row."""
    return df.groupBy(*keys).agg(*[F.count_if(p).alias(n) for n, p in measures.items()])


def distinct_where(df: DataFrame, keys: list[str], item: str, measures: dict[str, Column]) -> DataFrame:
    """``count(distinct item)`` per measure.

    Done in two steps, flags per (keys, item) and then a sum of flags: several
    filtered distinct counts in one ``agg`` would copy every row once per
    measure before the shuffle.
    """
    flags = df.groupBy(*keys, item).agg(*[F.bool_or(p).alias(n) for n, p in measures.items()])
    present = F.col(item).isNotNull()
    return flags.groupBy(*keys).agg(
        *[F.count_if(F.col(n) & present).alias(n) for n in measures]
    )
