"""Connected components of a link table, as joins and aggregations that run until nothing changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Rounds after which something must be wrong: each at least halves the longest chain.
ROUNDS = 64


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One star step over edges (u, v) with u > v: neighbours are hung below the least of a node's neighbourhood.

    Large star: each node's larger neighbours get its least neighbour. Small star: a node and its smaller neighbours do.
    """
    if small:
        around = edges
    else:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    hung = around.join(least, "u")
    if small:
        out = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(hung.select("u", F.col("m").alias("v")))
    else:
        out = hung.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    out = out.filter("u > v")
    return out.distinct() if small else out  # what the large star repeats, the small star folds


def _settled(edges: DataFrame) -> bool:
    """Whether each id hangs below one root and no root hangs below another: then the root is the least of its component."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("below"), F.lit(0).alias("above")).unionByName(edges.select(F.col("v").alias("id"), F.lit(0).alias("below"), F.lit(1).alias("above")))
    return ends.groupBy("id").agg(F.sum("below").alias("below"), F.max("above").alias("above")).filter("below > 1 or (below > 0 and above > 0)").isEmpty()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Each id that links name, with the smallest id it reaches: id, component.

    Alternating large and small stars. Every round's edges are written to the shared folder; the driver sees only
    whether any are left to hang. Null ids and loops link nothing. No links: no rows.
    """
    u, v = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    edges = cut(links.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(u, v).distinct())
    for _ in range(ROUNDS):
        if _settled(edges):
            break
        edges = cut(_star(_star(edges, small=False), small=True))
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
