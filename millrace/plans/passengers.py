"""Passenger table to model input."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.features import impute_mean, label_encode, one_hot
from millrace.operators.windows import fill_group_median


def clean(passengers: DataFrame, drop_id: bool = False, ports: list[str] | None = None, usual_port: str = "S") -> DataFrame:
    """Encode sex and port, fill fare and age, add the family size, drop raw columns."""
    rows = label_encode(passengers, "sex", "sex_val")
    rows = one_hot(rows.withColumn("embarked", F.coalesce("embarked", F.lit(usual_port))), "embarked", ports or ["C", "Q", "S"])
    rows = impute_mean(rows, ["fare"])
    rows = fill_group_median(rows, ["sex_val", "pclass"], "age", "age_fill")
    rows = rows.withColumn("family_size", F.col("sibsp") + F.col("parch"))
    return rows.drop("name", "sex", "cabin", "embarked", "age", "sibsp", "parch", *(["passenger_id"] if drop_id else []))
