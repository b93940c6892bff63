"""Running totals per key, positions over rounds, group medians and ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import number_rows, quantiles, running


def batches_per_round(details: DataFrame) -> DataFrame:
    """Highest batch of each (order, round) and its running total over the rounds.

    Also carries the previous round of the order, which later steps look back to.
    """
    rounds = details.groupBy("service_order_id", "round").agg(F.max("batch").alias("batch"))
    return running(rounds, ["service_order_id"], ["round"], {
        "cum_batch": ("sum", F.col("batch").cast("bigint"), True), "prev_round": ("max", F.col("round"), False)})


def fill_group_median(df: DataFrame, keys: list[str], column: str, name: str) -> DataFrame:
    medians = quantiles(df, keys, column, {"_median": 0.5})
    return df.join(medians, keys, "left").withColumn(name, F.coalesce(F.col(column).cast("double"), "_median")).drop("_median")


def top_with_ties(scores: DataFrame, score: str, n: int) -> DataFrame:
    """Rank by falling score; everything up to place n, including ties at the end.

    Only the distinct leading scores (at most n) are ranked.
    """
    per_score = scores.groupBy(F.col(score).alias("_s")).agg(F.count("*").alias("_c"))
    leading = per_score.orderBy(F.desc("_s")).limit(n)
    ranked = running(leading, [], [F.desc("_s")], {"_before": ("sum", F.col("_c"), False)})
    ranked = ranked.select("_s", (F.coalesce("_before", F.lit(0)) + 1).cast("int").alias("rank")).where(F.col("rank") <= n)
    return scores.join(F.broadcast(ranked), scores[score] == ranked["_s"]).drop("_s")


def with_batch_ids(df: DataFrame, order: list[str], size: int, name: str = "batch_id") -> DataFrame:
    """Consecutive batches of at most `size` rows in the given total order."""
    numbered = number_rows(df, order, "_n")
    return numbered.withColumn(name, F.floor((F.col("_n") - 1) / size)).drop("_n")
