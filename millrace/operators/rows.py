"""Row-wise projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_order(*times: str) -> Column:
    """True where the times strictly increase; equal or missing times fail."""
    ok = F.lit(True)
    for earlier, later in zip(times, times[1:]):
        ok = ok & (F.col(earlier) < F.col(later))
    return F.coalesce(ok, F.lit(False))


def rejects_per_rule(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """How many rows break each rule, counted in one pass; one row per rule."""
    counts = df.agg(F.count("*").alias("_all"), *[F.count_if(~F.coalesce(r, F.lit(False))).alias(n) for n, r in rules.items()])
    pairs = ", ".join(f"'{n}', `{n}`" for n in rules)
    return counts.selectExpr("_all as total", f"stack({len(rules)}, {pairs}) as (rule, rejected)").select("rule", "rejected", "total")


def first_positive(*columns: Column) -> Column:
    """The first value that is neither missing nor zero."""
    return F.coalesce(*[F.nullif(c, F.lit(0)) for c in columns])


def ratio(part: Column, whole: Column, digits: int | None = None) -> Column:
    value = F.try_divide(part, whole)
    return value if digits is None else F.round(value, digits)


def drop_sparse_columns(df: DataFrame, most: int) -> DataFrame:
    """Keep only columns with at most `most` NULLs."""
    missing = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if missing[c] <= most])
