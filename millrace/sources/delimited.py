"""Text files in and out: typed tab-separated text, CSV with null tokens, triples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def schema_from_description(description: str) -> T.StructType:
    """A pasted table description, one `name type` per line, as an explicit schema.

    Whole numbers and timestamps are epoch-style integers, all fractional types doubles.
    """
    kinds = {"int": T.LongType(), "timestamp": T.LongType(), "float": T.DoubleType(),
             "double": T.DoubleType(), "decimal": T.DoubleType()}
    fields = []
    for line in description.splitlines():
        words = line.split()
        if len(words) >= 2:
            kind = next((t for key, t in kinds.items() if key in words[1]), T.StringType())
            fields.append(T.StructField(words[0], kind))
    return T.StructType(fields)


def load_delimited(spark: SparkSession, path: str, schema: T.StructType, separator: str = "\t",
                   unique_by: list[str] | None = None) -> DataFrame:
    """Typed rows from delimited text. A bad or missing field is NULL, the row stays."""
    parts = F.split("value", separator)
    columns = []
    for i, field in enumerate(schema):
        piece = F.get(parts, i)
        columns.append((piece if isinstance(field.dataType, T.StringType) else piece.try_cast(field.dataType)).alias(field.name))
    rows = spark.read.text(path).select(*columns)
    return rows.dropDuplicates(unique_by) if unique_by else rows


def scan_csv(spark: SparkSession, path: str, schema: str, null_token: str = "null", header: bool = True,
             first: int | None = None) -> DataFrame:
    rows = spark.read.csv(path, schema=schema, header=header, nullValue=null_token)
    return rows.limit(first) if first is not None else rows


def export_delimited(df: DataFrame, path: str, separator: str = ",", order: list[str] | None = None) -> None:
    """Write delimited text. Part files are range-sorted, so joined in name order they are
    the one sorted file; no task sees the whole table."""
    out = df.orderBy(*order) if order else df
    out.write.mode("overwrite").option("sep", separator).csv(path, header=False)


def write_text(lines: DataFrame, path: str) -> None:
    lines.write.mode("overwrite").text(path)


def scan_triples(spark: SparkSession, path: str, prefix: str) -> DataFrame:
    """`<uri> <uri> <uri> .` lines; lines without exactly four words are left out."""
    words = F.split(F.trim("value"), r"\s+")
    start = len(prefix) + 2  # opening bracket and 1-based position
    short = lambda w: F.substring(w, F.lit(start), F.length(w) - start)
    return (
        spark.read.text(path)
        .select(words.alias("w"))
        .where(F.size("w") == 4)
        .select(short(F.col("w")[0]).alias("subject"), short(F.col("w")[1]).alias("predicate"), short(F.col("w")[2]).alias("object"))
    )
