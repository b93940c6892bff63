"""First look at a table before modelling: profile, correlation, gaps, outliers, log, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import aggregates, rows
from millrace.operators.features import one_hot
from millrace.operators.sampling import drop_extremes


def prepare(df: DataFrame, key: str, target: str, required: str, outlier_column: str, outliers: int, category: str, values: list, most_missing: int = 1) -> DataFrame:
    """Drop sparse columns and rows without `required`, trim outliers, log the target, encode."""
    kept = rows.drop_sparse_columns(df.where(F.col(required).isNotNull()), most_missing)
    trimmed = drop_extremes(kept, key, outlier_column, outliers)
    return one_hot(trimmed.withColumn(target, F.log(target)), category, values).drop(category)


def report(df: DataFrame, prepared: DataFrame, target: str, numeric: list[str]) -> DataFrame:
    """(step, name, value) rows of every stage of the first look."""
    profile = _long_profile(df, target)
    related = aggregates.correlations(df, [*numeric, target]).where((F.col("row_name") == target) | (F.col("col_name") == target))
    related = related.where("row_name <> col_name").select(
        F.lit("correlation").alias("step"), F.when(F.col("row_name") == target, F.col("col_name")).otherwise(F.col("row_name")).alias("name"), F.col("r").alias("value"))
    missing = aggregates.null_profile(df).select(F.lit("missing").alias("step"), "name", F.col("share").alias("value"))
    after = prepared.agg(F.count("*").cast("double").alias("rows"), F.avg(target).alias("log_mean")).unpivot([], ["rows", "log_mean"], "name", "value")
    return profile.unionByName(related).unionByName(missing).unionByName(after.select(F.lit("prepared").alias("step"), "name", "value"))


def _long_profile(df: DataFrame, target: str) -> DataFrame:
    wide = aggregates.describe(df, [target]).withColumn("n", F.col("n").cast("double")).drop("name")
    return wide.unpivot([], wide.columns, "name", "value").select(F.lit("profile").alias("step"), "name", "value")
