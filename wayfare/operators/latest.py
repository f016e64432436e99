"""One row per key: newest, oldest, and last-write-wins merges.

All are ``max``/``min`` of a struct, never a ranking window: partial results are
merged before the shuffle, so a key that holds a third of all rows sends one
row per input partition instead of all of them to one task. Ties are settled by
the remaining columns, which makes every result repeatable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _one_per(df: DataFrame, keys: list[str], order: list[str], values: list[str], pick) -> DataFrame:
    fields = order + [v for v in values if v not in order]
    picked = df.groupBy(*keys).agg(pick(F.struct(*fields)).alias("_picked"))
    return picked.select(*keys, *[F.col("_picked")[f].alias(f) for f in fields])


def newest_per(df: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    return _one_per(df, keys, order, values, F.max)


def oldest_per(df: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    return _one_per(df, keys, order, values, F.min)


def upsert_latest(target: DataFrame, changes: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """Whole-row last write wins. Rows without a key are skipped."""
    rows = target.unionByName(changes)
    values = [c for c in rows.columns if c not in keys and c not in version]
    keyed = rows.where(F.concat(*[F.col(k).cast("string") for k in keys]).isNotNull())
    return newest_per(keyed, keys, version, values).select(*target.columns)


def upsert_partial(target: DataFrame, changes: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Cell-wise last write wins: a NULL value leaves the stored cell untouched."""
    rows = target.unionByName(changes)
    cells = [c for c in rows.columns if c not in keys and c != version]

    def last_cell(name: str) -> Column:
        written = F.when(F.col(name).isNotNull(), F.struct(F.col(version).alias("v"), F.col(name).alias("c")))
        return F.max(written)["c"].alias(name)

    keyed = rows.where(F.concat(*[F.col(k).cast("string") for k in keys]).isNotNull())
    merged = keyed.groupBy(*keys).agg(*[last_cell(c) for c in cells], F.max(version).alias(version))
    return merged.select(*target.columns)


def newest_rows(df: DataFrame, order: str, n: int) -> DataFrame:
    """The newest n rows (a top-k, never a full sort); equal times are told apart by the other columns, in order."""
    rest = [c for c in df.columns if c != order]
    return df.orderBy(F.col(order).desc(), *[F.col(c).desc() for c in rest]).limit(n)
