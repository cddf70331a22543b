"""Connected components over links between distinct classes, without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stages

MAX_ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    """Two numbers that tell sets of links apart."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame, stages: Stages, name: str = "links") -> DataFrame:
    """(node, root): for each node of links (u, v) the least node that it reaches.

    Large-star and small-star steps in turn: every step hangs neighbours on the least known
    node, so rounds grow with the logarithm of a component's size. Neighbours are reduced to
    their minimum by partial aggregation, never gathered; a hub's links are joined to its
    minimum, which adaptive execution can split. Each round is a written table.
    """
    edges = stages.keep(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{name}-0"
    )
    before = _state(edges)
    for k in range(1, MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        # a node that is its own least keeps no link; its neighbours hang on it
        kept = large.distinct()
        down = kept.groupBy("u").agg(F.min("v").alias("m"))
        small = kept.join(down, "u").select(
            F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        ).select("e.u", "e.v").where("u <> v").distinct()
        new = stages.keep(small, f"{name}-{k}")
        now = _state(new)
        stages.drop(f"{name}-{k - 1}")
        edges, before, same = new, now, now == before
        if same:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")
