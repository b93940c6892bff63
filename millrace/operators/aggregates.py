"""Grouped counts, bins, profiles, correlations, price bars, shares and step counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from millrace.operators.ordered import number_rows, quantiles
from millrace.operators.rows import ratio

# fixed values: upper bounds of the waiting-time bins, in minutes; the last bin is open
WAIT_BOUNDS = [5, 10, 20, 30, 60, 120, 240, 360, 600]
OPEN_BIN = 10000


def wait_bin(minutes: Column) -> Column:
    """Upper bound of the left-closed bin; the open last bin is 10000, no value is -1."""
    label = F.when(minutes.isNull(), -1)
    for bound in WAIT_BOUNDS:
        label = label.when(minutes < bound, bound)
    return label.otherwise(OPEN_BIN)


def binned_waits(intervals: DataFrame) -> DataFrame:
    """Count of waits per day, city and bin, for rows whose times are in order."""
    waited = intervals.where(F.col("start_time") > F.col("create_time"))
    minutes = (F.unix_timestamp("start_time") - F.unix_timestamp("create_time")) / 60
    return waited.groupBy("dt", "city", wait_bin(minutes).alias("label")).agg(F.count("*").alias("n"))


def day_spine(df: DataFrame, day: str, width: str, name: str) -> DataFrame:
    """All time bins of every day present in the data."""
    days = df.select(day).distinct()
    start = F.col(day).cast("timestamp_ntz")
    bins = F.sequence(start, start + F.expr("interval 1 day") - F.expr(f"interval {width}"), F.expr(f"interval {width}"))
    return days.select(day, F.explode(bins).alias(name))


def halfhour_counts(rows: DataFrame, day: str, ts: str, tag: str) -> DataFrame:
    """Per day and half hour the number of rows with and without the tag. Empty bins give 0;
    rows whose bin is not on their day are left out."""
    binned = rows.withColumn("bin", F.window(ts, "30 minutes")["start"].cast("timestamp_ntz")).where(F.to_date("bin") == F.col(day))
    counts = binned.groupBy(day, "bin").agg(F.count_if(~F.col(tag)).alias("le_30mins"), F.count_if(F.col(tag)).alias("gt_30mins"))
    return day_spine(rows, day, "30 minutes", "bin").join(counts, [day, "bin"], "left").na.fill(0, ["le_30mins", "gt_30mins"])


def null_profile(df: DataFrame) -> DataFrame:
    """Missing count and share per column, one pass."""
    counts = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    long = counts.selectExpr("_n", f"stack({len(df.columns)}, {pairs}) as (name, total)")
    return long.select("name", "total", ratio(F.col("total"), F.col("_n")).alias("share"))


def unpivot(df: DataFrame, columns: list[str], name: str = "name", value: str = "value") -> DataFrame:
    return df.unpivot([], [F.col(c).cast("double").alias(c) for c in columns], name, value)


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, sample std, min, quartiles and max per column."""
    long = unpivot(df, columns)
    basic = long.groupBy("name").agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
                                     F.min("value").alias("min"), F.max("value").alias("max"))
    return basic.join(quantiles(long, ["name"], "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75}), "name", "left")


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson r of all column pairs (lower triangle with diagonal), one pass over the rows."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[: i + 1]]
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = ", ".join(f"'{a}', '{b}', r{i}" for i, (a, b) in enumerate(pairs))
    return wide.selectExpr(f"stack({len(pairs)}, {cells}) as (row_name, col_name, r)")


def most_correlated(df: DataFrame, columns: list[str], target: str, k: int) -> DataFrame:
    """The correlation sub-matrix of the k columns with the highest signed r to the target."""
    matrix = correlations(df, columns)
    mirrored = matrix.unionByName(matrix.where("row_name <> col_name").select(
        F.col("col_name").alias("row_name"), F.col("row_name").alias("col_name"), "r"))
    top = mirrored.where(F.col("row_name") == target).orderBy(F.desc("r"), "col_name").limit(k).select(F.col("col_name").alias("kept"))
    kept = [r[0] for r in top.collect()]  # at most k names
    return mirrored.where(F.col("row_name").isin(kept) & F.col("col_name").isin(kept))


def price_bars(prices: DataFrame, keys: list[Column], order: list[str], price: str) -> DataFrame:
    """Open, high, low, close per group."""
    at = F.struct(*order)
    return prices.groupBy(*keys).agg(F.min_by(price, at).alias("open"), F.max(price).alias("high"),
                                     F.min(price).alias("low"), F.max_by(price, at).alias("close"))


def bars_every(prices: DataFrame, rows: int, order: list[str], price: str) -> DataFrame:
    numbered = number_rows(prices, order, "_n")
    return price_bars(numbered, [F.floor((F.col("_n") - 1) / rows).alias("stick")], order, price)


def top_shares(df: DataFrame, group: str, category: str, k: int) -> DataFrame:
    """The k most frequent categories of each group and their share of the group.

    Counts come first, so the ranking only sees one row per (group, category).
    """
    counts = df.groupBy(group, category).agg(F.count("*").alias("n"))
    sizes = counts.groupBy(group).agg(F.sum("n").alias("size"))
    order = [F.desc("n"), F.col(category)]
    ranked = number_rows(counts, order, "rank", [group]).where(F.col("rank") <= k)
    return ranked.join(sizes, group).select(group, category, "n", (F.col("n") / F.col("size")).alias("share"), "rank")


class StepCounter:
    """Counts rows passing each step of a plan during the one action that runs it.

    Build the plan in a session of its own (`spark.newSession()`): a session that has observed
    something can no longer be shipped inside fitted models.
    """

    def __init__(self):
        self._seen: list[tuple[str, Observation]] = []

    def watch(self, df: DataFrame, step: str) -> DataFrame:
        seen = Observation(f"{step}_{id(self)}")
        self._seen.append((step, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("n"))

    def counts(self) -> list[tuple[str, int]]:
        return [(step, seen.get["n"]) for step, seen in self._seen]
