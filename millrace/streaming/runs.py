"""Starting streams: sources, sinks, and runs that stop when the input is used up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.ordered import number_rows
from millrace.session import cut


def message_stream(spark: SparkSession, fmt: str, options: dict, schema: str | None = None) -> DataFrame:
    """Messages from files or a broker. Kafka values arrive as bytes and become `message`."""
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "kafka":
        return reader.load().select(F.col("value").cast("string").alias("message"))
    rows = (reader.schema(schema) if schema else reader).load()
    return rows.withColumnRenamed("value", "message") if fmt == "text" else rows


def run_to_files(rows: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Append everything available to a file sink; the checkpoint makes it exactly-once."""
    rows.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()


def run_batches(rows: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def arrivals(df: DataFrame, order: list[str], parts: int) -> list[DataFrame]:
    """The rows as `parts` consecutive slices, as they would arrive one after the other."""
    numbered = cut(number_rows(df, order, "_n"))
    total = numbered.count()
    slot = F.floor((F.col("_n") - 1) * parts / max(total, 1))
    return [numbered.where(slot == i).drop("_n") for i in range(parts)]


def play(slices: list[DataFrame], path: str, step: Callable[[], None], fmt: str = "parquet") -> None:
    """Let each slice arrive in the folder, then run the stream over what is new."""
    for part in slices:
        part.write.mode("append").format(fmt).save(path)
        step()
