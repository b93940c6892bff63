"""Log messages: tokenise, parse, and route. The same columns serve batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import event_time, log_tokens

# fixed values: field names of the message layout, in order
FIELDS = ["datetime", "id", "json_str", "note"]


def tokenised(messages: DataFrame, fields: list[str] | None = None, width: int | None = None) -> DataFrame:
    """Named fields of each message; header lines are dropped, a wrong word count is a failure
    that keeps the first word only."""
    fields = fields or FIELDS
    width = width or len(fields)
    words = messages.where(~F.col("message").contains("datetime")).withColumn("_w", log_tokens(F.col("message")))
    failed = F.size("_w") != width
    named = [F.get("_w", F.lit(0)).alias(fields[0])]
    named += [F.when(~failed, F.get("_w", F.lit(i))).alias(f) for i, f in enumerate(fields) if i]
    return words.select(*messages.columns, *named, failed.alias("failed"))


def nested_value(document: Column, inner: str = "$.inner_json", field: str = "$.inner_value") -> Column:
    """Value from JSON held as text inside JSON; `-` where there is none."""
    text = F.get_json_object(document, inner)
    return F.when(text != "-", F.get_json_object(text, field)).otherwise("-")


def parsed(messages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Typed rows: event time, ids, the outer and the nested JSON fields. A message that cannot
    be split, or whose JSON cannot be read, is marked failed."""
    doc = F.col("json_str")
    broken = ~F.col("failed") & F.get_json_object(doc, "$").isNull()
    return tokenised(messages).select(
        *(keep or []), event_time(F.col("datetime")).alias("event_time"), F.col("id").try_cast("bigint").alias("id"),
        F.get_json_object(doc, "$.type").alias("ext_type"), F.get_json_object(doc, "$.version").alias("ext_version"),
        F.get_json_object(doc, "$.color").alias("ext_color"), F.when(~F.col("failed"), nested_value(doc)).alias("inner_value"),
        (F.col("failed") | broken).alias("failed"), "message")


def route(rows: DataFrame, good_path: str, error_path: str, batch_id: int) -> None:
    """Failed rows as text, good rows as CSV, one folder per date. Each batch owns its folder,
    so a repeated batch replaces its own output."""
    rows = rows.persist()
    dated = rows.withColumn("date", F.coalesce(F.date_format("event_time", "yyyyMMdd"), F.lit("undated")))
    errors = dated.where("failed").select("date", F.concat_ws(" ", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"), "message").alias("value"))
    good = dated.where("not failed").select("date", "event_time", "id", "ext_type", "ext_version", "ext_color", "inner_value")
    errors.hint("rebalance", "date").write.mode("overwrite").partitionBy("date").text(f"{error_path}/batch_id={batch_id}")
    good.hint("rebalance", "date").write.mode("overwrite").partitionBy("date").csv(f"{good_path}/batch_id={batch_id}")
    rows.unpersist()
