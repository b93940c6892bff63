"""Left joins on null-safe keys, deduplicated lookups, semi joins and detail look-back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_nullsafe(left: DataFrame, right: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Left outer join where NULL keys match NULL keys; the right-hand keys are dropped.

    Planned as an equi-join; a hot key on the left is split by the adaptive skew join.
    """
    renamed = right
    for i, name in enumerate(keys.values()):
        renamed = renamed.withColumnRenamed(name, f"_rk{i}")
    match = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_rk{i}"]) for i, k in enumerate(keys)])
    return left.join(renamed, match, "left").drop(*[f"_rk{i}" for i in range(len(keys))])


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """The smallest full row of each key: a grouped minimum, combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def last_per_key(df: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """Values of the row that is greatest in `order` (end it with a unique column)."""
    pick = F.max(F.struct(*order, *[F.col(v).alias(f"_v_{v}") for v in values])).alias("_r")
    return df.groupBy(*keys).agg(pick).select(*keys, *[F.col(f"_r._v_{v}").alias(v) for v in values])


def first_per_key(df: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    pick = F.min(F.struct(*order, *[F.col(v).alias(f"_v_{v}") for v in values])).alias("_r")
    return df.groupBy(*keys).agg(pick).select(*keys, *[F.col(f"_r._v_{v}").alias(v) for v in values])


def at_edge(details: DataFrame, key: str, position: str, values: list[str], last: bool = False) -> DataFrame:
    """Minimum and maximum of `values` over a key's rows at its first (or last) position.

    Two combined aggregations do what "find the position, join back, aggregate" does,
    without a join and without gathering a key's rows.
    """
    extremes = [f(v).alias(f"{n}_{v}") for v in values for n, f in (("min", F.min), ("max", F.max))]
    per_position = details.groupBy(key, position).agg(*extremes)
    names = [f"{n}_{v}" for v in values for n in ("min", "max")]
    pick = F.max if last else F.min
    chosen = per_position.groupBy(key).agg(pick(F.struct(position, *names)).alias("_r"))
    return chosen.select(key, F.col(f"_r.{position}").alias(position), *[F.col(f"_r.{n}").alias(n) for n in names])


def keep_matching(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    return df.join(other.select(key), key, "left_semi")
