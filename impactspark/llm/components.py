"""Connected components of an edge table by alternating large-star and small-star steps.

Each round is two aggregates and two joins over the remaining edges and is
written to the shared folder, so nothing is collected and a lost executor
costs one round at most.  The edges end as stars around the smallest id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first())


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """``(id, component)`` for every id that has an edge to another one.

    ``component`` is the smallest id reachable, the id itself included.
    Edges with a null end, loops and repeated edges are allowed.
    """
    a, b = F.col(u), F.col(v)
    now = staged(edges.where(a.isNotNull() & b.isNotNull() & (a != b))
                 .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "cc-edges")
    before = None
    while True:
        state = _state(now)
        if state == before or state[0] == 0:
            break
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = staged(large, "cc-large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))))
        now = staged(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                     .where("u != v").distinct(), "cc-edges")
    members = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    heads = now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return members.unionByName(heads)
