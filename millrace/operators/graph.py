"""Redirect closure, link numbering and power-iteration ranking on edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import dense_index
from millrace.session import cut, drop_cut


def _advance(table: DataFrame) -> DataFrame:
    """One pointer-doubling step on (src, at); `open` tells whether `at` leads further."""
    ahead = table.select(F.col("src").alias("_s"), F.col("at").alias("_at"))
    return table.join(ahead, F.col("at") == F.col("_s"), "left").select("src", F.coalesce("_at", "at").alias("at"), F.col("_s").isNotNull().alias("open"))


def resolve_redirects(redirects: DataFrame, rounds: int = 64) -> DataFrame:
    """(src, target): where following (src, dst) ends.

    A walk that runs into a cycle stops at the last target it has not met; the source and
    every target from the second on count as met. Pointer doubling needs log2(longest walk)
    joins; walks into cycles are recognised when the sets of open rows and of their images
    stop shrinking.
    """
    first = cut(redirects.select("src", F.col("dst").alias("at")))
    walked, seen = first, None
    for _ in range(rounds):
        last, walked = walked, cut(_advance(walked.select("src", "at")))
        if last is not first:
            drop_cut(last)
        row = walked.where("open").agg(F.count("*"), F.count_distinct("at")).first()
        if row[0] == 0 or tuple(row) == seen:
            break
        seen = tuple(row)
    else:
        raise RuntimeError("redirects did not settle")
    # a row just reaching its end is still marked open; what leads on from `at` decides
    sources = redirects.select(F.col("src").alias("_s"))
    ended = walked.join(sources, F.col("at") == F.col("_s"), "left_anti").select("src", F.col("at").alias("target"))
    looping = cut(walked.join(sources, F.col("at") == F.col("_s"), "left_semi").select("src", "at"))
    if looping.isEmpty():
        return ended
    on_cycle = cut(looping.select(F.col("at").alias("node")).distinct())
    before = cut(redirects.join(on_cycle, F.col("src") == F.col("node")).select(F.col("dst").alias("node"), F.col("src").alias("before")))
    # walk every looping source to its first cycle node: cycle nodes point at themselves
    inside = on_cycle.select("node", F.lit(True).alias("inside"))
    steps = first.join(looping.select("src"), "src", "left_semi").join(inside, F.col("src") == F.col("node"), "left")
    entry = cut(steps.select("src", F.when(F.col("inside"), F.col("src")).otherwise(F.col("at")).alias("at")))
    for _ in range(rounds):
        outside = entry.join(on_cycle, F.col("at") == F.col("node"), "left_anti")
        if outside.isEmpty():
            break
        entry = cut(_advance(entry).select("src", "at"))
    # a source one step before the cycle meets its first target a second time and stops there
    last = entry.join(before, F.col("at") == F.col("node")).join(first.withColumnRenamed("at", "_first"), "src")
    direct = (F.col("_first") == F.col("at")) & (F.col("src") != F.col("at"))
    return ended.unionByName(last.select("src", F.when(direct, F.col("at")).otherwise(F.col("before")).alias("target")))


def link_index(links: DataFrame, resolved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links with both ends resolved, numbered and deduplicated: (edges i, j; nodes name, i)."""
    src = resolved.select(F.col("src").alias("_a"), F.col("target").alias("_ta"))
    dst = resolved.select(F.col("src").alias("_b"), F.col("target").alias("_tb"))
    ends = links.join(src, F.col("src") == F.col("_a"), "left").join(dst, F.col("dst") == F.col("_b"), "left").select(
        F.coalesce("_ta", "src").alias("src"), F.coalesce("_tb", "dst").alias("dst")).distinct()
    ends = cut(ends)
    names = ends.select(F.col("src").alias("name")).unionByName(ends.select(F.col("dst").alias("name")))
    nodes = cut(dense_index(names, "name", "i"))
    left, right = nodes.select(F.col("name").alias("src"), "i"), nodes.select(F.col("name").alias("dst"), F.col("i").alias("j"))
    return ends.join(left, "src").join(right, "dst").select("i", "j"), nodes


def pagerank(edges: DataFrame, alpha: float = 0.85, rounds: int = 100, tolerance: float = 1e-10, early_stop: bool = True) -> DataFrame:
    """(node, score) of distinct edges (src, dst).

    Dangling nodes spread their score evenly. Stops when the largest change relative to the
    largest score is below n * tolerance. Each round joins edges with one row per node and
    sums per target (combined before the shuffle); its result is written, so a lost executor
    repeats at most one round.
    """
    edges = cut(edges.select("src", "dst").distinct())
    degree = edges.groupBy(F.col("src").alias("node")).agg(F.count("*").alias("out"))
    nodes = edges.select(F.col("src").alias("node")).unionByName(edges.select(F.col("dst").alias("node"))).distinct()
    table = cut(nodes.join(degree, "node", "left").withColumn("out", F.coalesce("out", F.lit(0))))
    n = table.count()
    if n == 0:
        return table.select("node", F.lit(0.0).alias("score"))
    table = table.withColumn("score", F.lit(1.0 / n))
    dangling, total = table.agg(F.sum(F.when(F.col("out") == 0, F.col("score")).otherwise(0.0)), F.sum("score")).first()
    for _ in range(rounds):
        giving = table.where("out > 0").select(F.col("node").alias("src"), (F.col("score") / F.col("out")).alias("share"))
        received = edges.join(giving, "src").groupBy(F.col("dst").alias("node")).agg(F.sum("share").alias("got"))
        base = alpha * dangling / n + (1 - alpha) * total / n
        fresh = (F.coalesce("got", F.lit(0.0)) * alpha + base).alias("score")
        last, table = table, cut(table.withColumnRenamed("score", "old").join(received, "node", "left").select("node", "out", "old", fresh))
        change, top, dangling, total = table.agg(
            F.max(F.abs(F.col("score") - F.col("old"))), F.max(F.abs("score")),
            F.sum(F.when(F.col("out") == 0, F.col("score")).otherwise(0.0)), F.sum("score")).first()
        table = table.drop("old")
        drop_cut(last)
        if early_stop and change / (top or 1.0) < n * tolerance:
            break
    return table.select("node", "score")
