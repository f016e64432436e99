"""Connected components of links between numbered things."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import drop_stored, stored


def connected_components(links: DataFrame) -> DataFrame:
    """id, root (the smallest id of the component) of every id in ``links`` (columns a, b; no nulls).

    Alternates two steps that hang neighbours under their smallest neighbour until
    nothing changes; a step is an aggregation and a join, and every round is a
    written table, so a hub with many links is merged before it is shuffled and a
    lost executor costs one round.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        hung = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = hung.groupBy("u").agg(F.min("v").alias("m"))
        moved = hung.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        last, edges = edges, stored(moved.union(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        drop_stored(last)
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    out = edges.select(F.col("u").alias("id"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())
    out.stored_at = edges.stored_at
    return out
