"""Balanced label propagation: linked rows move towards their neighbours' shards under quotas.

Rows that share a hub (a group key, here equal texts) are linked through it, so a group of m
rows is m memberships, never m squared pairs. Rows start evenly spread. In each round every hub
counts its members per shard and attracts them to the shard where most of them are, or to as
many of its fullest shards as it needs by size; wishes are granted up to quotas that keep the
number of rows of every shard as it is: whoever enters beyond those who leave displaces rows
without links. Ranks within wishes come from the range-partitioned numbering, so no task sorts
a whole shard, and only shards x shards totals reach the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.ordered import number_rows
from millrace.session import cut

ROUNDS = 4


def granted(wishes: np.ndarray, free: np.ndarray) -> np.ndarray:
    """The largest simple cut of the wish matrix (from, to) that free rows can make room for.

    A shard may take in as many rows as leave it plus its free rows. Cutting what enters one
    shard lets fewer leave another, so it is repeated until nothing has to be cut.
    """
    grant = wishes.copy()
    np.fill_diagonal(grant, 0)
    while True:
        room = grant.sum(axis=1) + free
        over = np.flatnonzero(grant.sum(axis=0) > room)
        if not len(over):
            return grant
        for t in over:
            left = int(room[t])
            share = grant[:, t] * left // max(int(grant[:, t].sum()), 1)
            for s in np.argsort(-grant[:, t], kind="stable")[: left - int(share.sum())]:
                share[s] += share[s] < grant[s, t]
            grant[:, t] = share


def displaced(grant: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(shard, first, last, to): which free rows, by their number in a shard, go where to keep all counts."""
    net = grant.sum(axis=0) - grant.sum(axis=1)
    takers = [[s, int(-n)] for s, n in enumerate(net) if n < 0]
    out = []
    for t, n in enumerate(net):
        at = 0
        while n - at > 0:
            s, want = takers[-1]
            k = min(want, int(n) - at)
            out.append((t, at + 1, at + k, int(s)))
            at += k
            takers[-1][1] -= k
            if not takers[-1][1]:
                takers.pop()
    return out


def _matrix(rows: list, shards: int) -> np.ndarray:
    out = np.zeros((shards, shards), np.int64)
    for r in rows:
        out[r["shard"], r["to"]] = r["n"]
    return out


def _round(state: DataFrame, hubs: DataFrame, shards: int, capacity: int, turn: int) -> DataFrame | None:
    """One round over (row, hub, shard); None if no row wants to move or may."""
    linked = state.join(hubs, "hub")
    held = linked.groupBy("hub", "size", "shard").agg(F.count("*").alias("n"))
    order = Window.partitionBy("hub").orderBy(F.col("n").desc(), F.xxhash64("hub", "shard"))  # at most one row per shard
    best = held.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= F.ceil(F.col("size") / capacity))
    tops = best.groupBy("hub").agg(F.sort_array(F.collect_list(F.struct("rank", "shard", "n"))).alias("tops"))
    pick = F.col("tops")[F.pmod(F.xxhash64("row", F.lit(turn)), F.size("tops")).cast("int")]
    wishes = linked.join(tops, "hub").where(~F.exists("tops", lambda t: t["shard"] == F.col("shard"))).select("row", "shard", pick["shard"].alias("to"), pick["n"].alias("gain"))
    wishes = cut(wishes)
    wanted = _matrix(wishes.groupBy("shard", "to").agg(F.count("*").alias("n")).collect(), shards)
    if not wanted.any():
        return None
    loose = state.join(hubs.select("hub"), "hub", "left_anti").select("row", "shard")
    free = np.zeros(shards, np.int64)
    for r in loose.groupBy("shard").count().collect():
        free[r["shard"]] = r["count"]
    grant = granted(wanted, free)
    if not grant.any():
        return None
    spark = state.sparkSession
    quota = spark.createDataFrame([(int(s), int(t), int(grant[s, t])) for s, t in zip(*np.nonzero(grant))], "shard int, to int, quota bigint")
    ranked = number_rows(wishes.withColumn("loss", -F.col("gain")), ["loss", "row"], "at", ["shard", "to"])
    moves = ranked.join(F.broadcast(quota), ["shard", "to"]).where("at <= quota").select("row", "to")
    if push := displaced(grant):
        table = spark.createDataFrame(push, "shard int, first bigint, last bigint, to int")
        numbered = number_rows(loose, ["row"], "at", ["shard"])
        pushed = numbered.join(F.broadcast(table), (numbered["shard"] == table["shard"]) & numbered["at"].between(table["first"], table["last"])).select("row", "to")
        moves = moves.unionByName(pushed)
    return cut(state.join(moves, "row", "left").select("row", "hub", F.coalesce("to", "shard").alias("shard")))


def balanced_labels(rows: DataFrame, shards: int, rounds: int = ROUNDS) -> DataFrame:
    """(row, shard) for (row, hub) with rows numbered from 1; every shard keeps n // shards or one more rows.

    A null hub links nothing. Rounds end early when no row wants or is allowed to move.
    """
    state = cut(rows.select("row", "hub", F.pmod(F.col("row") - 1, F.lit(shards)).cast("int").alias("shard")))
    hubs = cut(state.where("hub is not null").groupBy("hub").agg(F.count("*").alias("size")).where("size > 1"))
    capacity = max(1, state.count() // shards)
    for turn in range(rounds):
        moved = _round(state, hubs, shards, capacity, turn)
        if moved is None:
            break
        state = moved
    return state.select("row", "shard")


def shard_documents(docs: DataFrame, shards: int = 24, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) per row, under the law `rows`.

    Shards hold as many rows as each other, give or take one; documents of equal text, also
    empty ones, are drawn together. Groups larger than a shard fill as many shards as they
    need. size is the text's UTF-8 bytes plus 8, a null text has none and no links. slot counts
    each shard's rows from 0 by doc_id. Repeated rows and null ids are rows like all others;
    an empty table gives no rows; further columns are ignored. grown_shard is null, as it
    belongs to another law.
    """
    text = F.col(text_col)
    base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("bigint").alias("size"),
                       F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), F.sha2(text, 256).alias("hub"))
    numbered = cut(number_rows(base, ["doc_id", "hub", "size"], "row"))
    placed = numbered.join(balanced_labels(numbered.select("row", "hub"), shards, rounds), "row")
    slots = number_rows(placed.select("row", "doc_id", "size", "text_crc32", "shard"), ["doc_id", "row"], "slot", ["shard"])
    return slots.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("slot") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
