"""Joins for keys that hold a large share of the rows.

The ordinary equi-join is the default everywhere: adaptive execution splits its
skewed partitions, and each input is read once. ``salted_join`` is for callers
that know a key to be hot and run without adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def salted_join(facts: DataFrame, lookup: DataFrame, keys: list[str], spread_by: list[str], salts: int) -> DataFrame:
    """Inner join with the lookup repeated per salt, for a lookup much smaller than the facts.

    The salt is a hash of row columns, not a random number, so a recomputed
    task yields the same rows.
    """
    if salts <= 1:
        return facts.join(lookup, keys)
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*keys, "_salt"]).drop("_salt")
