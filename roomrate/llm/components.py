"""Connected components of a graph given as a DataFrame of edges.

Alternates large-star and small-star steps (Kiveris et al., "Connected
Components in MapReduce and Beyond"): each step points nodes at the smallest
neighbour they know, and the edge set turns into stars around the smallest
node of each component. Each round is staged in the shared checkpoint folder,
so lineage stays short and a lost executor costs at most one round; the round
before it is deleted.

No task holds a hub's edges. A node's neighbours are dealt by (node, salt), the
salt a hash of the neighbour: minima are taken per (node, salt), then per node,
and go back to the salts that the node has before they meet the edges. Of a
small graph (at most ``BROADCAST_ROWS`` edges) the minima are broadcast instead,
and its edges stay in ``TASKS`` tasks: a round is a few small stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomrate.llm.common import BROADCAST_ROWS, Scratch, staged

SALTS = 256
#: Tasks of a round of a small graph.
TASKS = 6


def _digest(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _least(edges: DataFrame, small: bool) -> tuple[DataFrame, DataFrame]:
    """Edges (u, v, m) with m the smallest v of their u; and (u, m)."""
    if small:
        low = edges.groupBy("u").agg(F.min("v").alias("m")).coalesce(TASKS)
        return edges.join(F.broadcast(low), "u").select("u", "v", "m"), low
    salted = edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    parts = salted.groupBy("u", "salt").agg(F.min("v").alias("m"))
    low = parts.groupBy("u").agg(F.min("m").alias("m"))
    back = parts.select("u", "salt").join(low, "u")
    return salted.join(back, ["u", "salt"]).select("u", "v", "m"), low


def _round(e: DataFrame, small: bool) -> DataFrame:
    few = (lambda df: df.coalesce(TASKS)) if small else (lambda df: df)
    # large star: neighbours above a node move to the smallest node around it
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    around, _ = _least(both, small)
    large = few(around.filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
    # small star: neighbours below a node, and the node, move to the smallest of them
    around, low = _least(large, small)
    moved = around.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return few(moved.unionByName(low.select("u", F.col("m").alias("v")))
               .filter("u <> v").distinct())


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns u, v), a staged
    table; ``component`` is the smallest node of the node's component. Nulls
    and loops are ignored; repeated edges count once. No edges: no rows."""
    with Scratch(edges.sparkSession) as scratch:
        e = scratch.stage(edges.filter("u <> v")
                          .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                          "edges")
        seen = _digest(e)
        for _ in range(max_rounds):
            if not seen[0]:
                break
            before, e = e, scratch.stage(_round(e, seen[0] <= BROADCAST_ROWS), "components")
            scratch.drop(before)
            now = _digest(e)
            if now == seen:
                break
            seen = now
        else:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
        roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
        return staged(e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots),
                      "components")
