"""Running totals, row numbers and exact quantiles that never sort in one task.

Rows are range-partitioned by (keys, order), so a hot key is spread over many
partitions. Each partition computes its own running values; the partitions' totals
(at most two rows per partition) carry the rest across partition borders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import cut


def _columns(order) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def _same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def running(df: DataFrame, keys: list[str], order: list, totals: dict) -> DataFrame:
    """Add running values per key in the given order.

    `totals` maps a new column to (kind, column, inclusive), kind being "sum" or "max".
    (keys, order) must identify a row, otherwise equal rows have no defined order.
    """
    combine = {"sum": F.sum, "max": F.max}
    staged = df
    for name, (_, value, _) in totals.items():
        staged = staged.withColumn(f"_v_{name}", value)
    laid = cut(
        staged.repartitionByRange(*_columns(keys), *_columns(order)).withColumn(
            "_pid", F.spark_partition_id()
        )
    )
    sums = [combine[kind](f"_v_{name}").alias(f"_o_{name}") for name, (kind, _, _) in totals.items()]
    if keys:
        named = F.struct(*keys)
        borders = laid.groupBy("_pid").agg(F.min(named).alias("lo"), F.max(named).alias("hi"))
        borders = borders.select("_pid", F.explode(F.array_distinct(F.array("lo", "hi"))).alias("k"))
        borders = borders.select(F.col("_pid").alias("_b"), *[F.col(f"k.{c}").alias(f"_k_{c}") for c in keys])
        match = _same(laid["_pid"], borders["_b"])
        for c in keys:
            match = match & _same(laid[c], borders[f"_k_{c}"])
        parts = laid.join(F.broadcast(borders), match).groupBy("_b", *[f"_k_{c}" for c in keys]).agg(*sums)
    else:
        parts = laid.groupBy(F.col("_pid").alias("_b")).agg(*sums)
    before = Window.partitionBy(*([f"_k_{c}" for c in keys] or [F.lit(0)])).orderBy("_b")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts
    for name, (kind, _, _) in totals.items():
        offsets = offsets.withColumn(f"_o_{name}", combine[kind](f"_o_{name}").over(before))
    within = Window.partitionBy("_pid", *keys).orderBy(*_columns(order))
    out = laid
    for name, (kind, _, inclusive) in totals.items():
        frame = within.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
        out = out.withColumn(f"_l_{name}", combine[kind](f"_v_{name}").over(frame))
    match = _same(out["_pid"], offsets["_b"])
    for c in keys:
        match = match & _same(out[c], offsets[f"_k_{c}"])
    out = out.join(F.broadcast(offsets), match, "left")
    final = [c for c in df.columns]
    for name, (kind, _, _) in totals.items():
        local, carried = F.col(f"_l_{name}"), F.col(f"_o_{name}")
        if kind == "sum":
            value = F.coalesce(local + carried, local, carried)
        else:
            value = F.greatest(local, carried)
        final.append(value.alias(name))
    return out.select(*final)


def number_rows(df: DataFrame, order: list, name: str, keys: list[str] | None = None) -> DataFrame:
    """1-based row number in the given total order, per key if keys are given."""
    return running(df, keys or [], order, {name: ("sum", F.lit(1).cast("bigint"), True)})


def dense_index(values: DataFrame, column: str, name: str) -> DataFrame:
    """0-based position of each distinct value in sorted order."""
    distinct = values.select(column).where(F.col(column).isNotNull()).distinct()
    return number_rows(distinct, [column], "_n").select(column, (F.col("_n") - 1).alias(name))


def quantiles(df: DataFrame, keys: list[str], column: str, probabilities: dict[str, float]) -> DataFrame:
    """Exact quantiles with linear interpolation, from counts per distinct value."""
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(*keys, column)
        .agg(F.count("*").alias("_c"))
    )
    ranked = running(counts, keys, [column], {"_upto": ("sum", F.col("_c"), True)})
    if keys:
        sizes = ranked.groupBy(*[F.col(k).alias(f"_n_{k}") for k in keys]).agg(F.max("_upto").alias("_n"))
        match = None
        for k in keys:
            one = _same(ranked[k], sizes[f"_n_{k}"])
            match = one if match is None else match & one
        ranked = ranked.join(sizes, match)
    else:
        size = ranked.agg(F.max("_upto")).first()[0]
        ranked = ranked.withColumn("_n", F.lit(size))
    picks = []
    for i, p in enumerate(probabilities.values()):
        position = (F.col("_n") - 1) * F.lit(float(p))
        for side, at in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            picks.append(F.min(F.when(F.col("_upto") > at, F.col(column))).alias(f"_{side}{i}"))
    out = ranked.groupBy(*keys).agg(F.max("_n").alias("_n"), *picks)
    final = []
    for i, (name, p) in enumerate(probabilities.items()):
        position = (F.col("_n") - 1) * F.lit(float(p))
        share = position - F.floor(position)
        low = F.col(f"_lo{i}").cast("double")
        final.append((low + (F.col(f"_hi{i}").cast("double") - low) * share).alias(name))
    return out.select(*keys, *final)
