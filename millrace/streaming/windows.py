"""Tumbling half-hour counts on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def halfhour_stream(rows: DataFrame, day: str, ts: str, tag: str, delay: str = "1 day") -> DataFrame:
    """Counts per day, half hour and tag, emitted once the watermark has passed the bin.

    Same columns as the batch counts; rows whose bin is not on their day are left out.
    """
    binned = rows.withWatermark(ts, delay).withColumn("_w", F.window(ts, "30 minutes"))
    kept = binned.where(F.to_date("_w.start") == F.col(day))
    counts = kept.groupBy("_w", day).agg(F.count_if(~F.col(tag)).alias("le_30mins"), F.count_if(F.col(tag)).alias("gt_30mins"))
    return counts.select(day, F.col("_w.start").cast("timestamp_ntz").alias("bin"), "le_30mins", "gt_30mins")
