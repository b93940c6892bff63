"""Partitioned tables: scan, create, overwrite, backfill."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_partition(source: DataFrame, column: str, value, columns: list[str]) -> DataFrame:
    """One partition, chosen columns only; both reach the scan."""
    return source.where(F.col(column) == F.lit(value)).select(*columns)


def write_partitions(df: DataFrame, path: str, column: str, mode: str = "overwrite") -> None:
    """Replace (or append to) exactly the partitions present in `df`.

    The rebalance hint brings a partition's rows together but splits a huge one over
    several tasks and packs small ones, so neither hot days nor many tiny files result.
    """
    (
        df.hint("rebalance", column)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )


def create_table(spark: SparkSession, name: str, ddl: str, partition: str, location: str, drop: bool = False) -> None:
    if drop:
        spark.sql(f"drop table if exists {name}")
    spark.sql(f"create table if not exists {name} ({ddl}) using parquet partitioned by ({partition}) location '{location}'")


def insert_partition(df: DataFrame, name: str, partition: str, value) -> None:
    """Insert-overwrite of one static partition through the catalog."""
    columns = [c for c in df.columns if c != partition]
    df.sparkSession.sql(
        f"insert overwrite table {name} partition ({partition}={value}) select {', '.join(columns)} from {{rows}} where {partition} = {value}",
        rows=df,
    )


def backfill_days(df: DataFrame, path: str, day: str, first, last) -> DataFrame:
    """Load every day of a range in one write; the result has a row count for each day."""
    spark = df.sparkSession
    inside = df.where(F.col(day).between(F.lit(first), F.lit(last)))
    write_partitions(inside, path, day)
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias(day))
    loaded = spark.read.parquet(path).groupBy(day).agg(F.count("*").alias("n"))
    return days.join(loaded, day, "left").select(day, F.coalesce("n", F.lit(0)).cast("bigint").alias("n_rows"))
