"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelframe.session import checkpoint

# A node with more than this part of all edges (and this many) is a hub: there are at most twice as many hubs as HUBS.
HUBS, LEAST = 10_000, 256


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def _with_least(edges: DataFrame, total: int) -> DataFrame:
    """Edges with the smallest neighbour ``m`` of u. Minima combine on the map side; the edges of hubs stay where they are
    and meet a broadcast table of at most 2 * HUBS rows, so no task gathers the edges of a hub."""
    low = checkpoint(edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")))
    most = max(LEAST, total // HUBS)
    hubs = F.broadcast(low.where(F.col("n") > most).select("u", "m"))
    rest = edges.join(hubs, "u", "left_anti").join(low.where(F.col("n") <= most).select("u", "m"), "u")
    return edges.join(hubs, "u").unionByName(rest)


def _stars(edges: DataFrame, total: int) -> DataFrame:
    both = checkpoint(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))))
    low = _with_least(both, 2 * total).withColumn("m", F.least("u", "m"))
    large = checkpoint(low.where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
    low = _with_least(large, 2 * total)
    small = low.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
    return small.select("e.*").where("u <> v").distinct()


def components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """(u, root) for every node that some edge (u, v) names; root is the smallest node reachable.

    Each round is cut off by a reliable checkpoint. It ends when a round changes
    nothing; a graph that needs more than ``max_rounds`` raises, as part of a
    component is never returned for the whole. No edges give no rows; loops and
    repeated edges are ignored."""
    now = checkpoint(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = _signature(now)
    for _ in range(max_rounds):
        now = checkpoint(_stars(now, seen[0]))
        new = _signature(now)
        if new == seen:
            roots = now.select(F.col("v").alias("u"), F.col("v").alias("root")).distinct()
            return now.select("u", F.col("v").alias("root")).unionByName(roots)
        seen = new
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
