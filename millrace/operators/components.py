"""Connected components by contracting the edge list until no edge is left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import cut, drop_cut


def _follow(parents: DataFrame, rounds: int = 60) -> DataFrame:
    """Pointer doubling on (v, p) with p < v for non-roots, until every p is a root."""
    last = parents
    for _ in range(rounds):
        up = parents.select(F.col("v").alias("_v"), F.col("p").alias("_p"))
        step = cut(parents.join(up, F.col("p") == F.col("_v"), "left").select("v", F.coalesce("_p", "p").alias("np"), (F.coalesce("_p", "p") != F.col("p")).alias("moved")))
        drop_cut(last)
        last, parents = step, step.select("v", F.col("np").alias("p"))
        if step.where("moved").isEmpty():
            return parents
    raise RuntimeError("pointers did not settle")


def connected_components(vertices: DataFrame, edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(v, component): component is the smallest vertex id that can be reached.

    `vertices` has column v, `edges` columns a, b. Each round every vertex hooks onto its
    smallest neighbour (a combined minimum, so star centres are no hot spot), chains are
    shortened by pointer doubling, and edges are rewritten to the roots and deduplicated.
    Every size takes this road; nothing is gathered on the driver.
    """
    labels = vertices.select("v", F.col("v").alias("component"))
    left = cut(edges.where("a <> b").select("a", "b").distinct())
    for turn in range(rounds):
        if left.isEmpty():
            drop_cut(left)
            return labels
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooked = both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("p"))
        roots = _follow(cut(hooked))
        named = roots.select(F.col("v").alias("_v"), F.col("p").alias("_p"))
        before, labels = labels, cut(labels.join(named, F.col("component") == F.col("_v"), "left").select("v", F.coalesce("_p", "component").alias("component")))
        other = roots.select(F.col("v").alias("_w"), F.col("p").alias("_q"))
        old, left = left, cut(left.join(named, F.col("a") == F.col("_v")).join(other, F.col("b") == F.col("_w"))
                   .where("_p <> _q").select(F.least("_p", "_q").alias("a"), F.greatest("_p", "_q").alias("b")).distinct())
        drop_cut(old, roots, *([before] if turn else []))
    raise RuntimeError("components did not settle")
