"""Models that learn from a stream, with their state in tables.

Weights live in a table with one row per feature bucket, one version per batch, so a batch
that is repeated after a failure starts from the version before it and replaces its own.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.clustering import minibatch_update
from millrace.operators import text

BUCKETS = 1 << 18


def hashed_counts(docs: DataFrame, key: str) -> DataFrame:
    return text.hashed_counts(docs, key, text.words(F.col("text")), BUCKETS)


def _version(spark: SparkSession, path: str, batch_id: int, schema: str) -> DataFrame:
    """State before a batch; empty before the first."""
    return spark.read.schema(schema).parquet(f"{path}/v={batch_id - 1}") if batch_id else spark.createDataFrame([], schema)


def _margins(counts: DataFrame, weights: DataFrame, key: str) -> DataFrame:
    return counts.join(weights, "bucket", "left").groupBy(key).agg(
        F.sum(F.col("n") * F.coalesce("w", F.lit(0.0))).alias("m"), F.sum(F.col("n") * F.col("n")).cast("double").alias("sq"))


def linear_update(batch: DataFrame, path: str, batch_id: int, kind: str, key: str = "doc_id") -> None:
    """One averaged step of a linear model over the batch: "sgd" (hinge), "perceptron" or
    "passive_aggressive"."""
    spark = batch.sparkSession
    weights = _version(spark, path, batch_id, "bucket bigint, w double")
    counts = hashed_counts(batch, key)
    signed = batch.select(key, F.when(F.col("label") > 0, 1.0).otherwise(-1.0).alias("y"))
    judged = _margins(counts, weights, key).join(signed, key)
    slack = 1 - F.col("y") * F.col("m")
    move = {"perceptron": F.when(F.col("y") * F.col("m") <= 0, F.col("y")), "sgd": F.when(slack > 0, F.col("y") / (1 + batch_id)),
            "passive_aggressive": F.when(slack > 0, F.col("y") * F.least(F.lit(1.0), slack / F.col("sq")))}[kind]
    moving = judged.select(key, move.alias("t")).where("t is not null")
    size = max(batch.count(), 1)
    change = counts.join(moving, key).groupBy("bucket").agg((F.sum(F.col("n") * F.col("t")) / size).alias("w"))
    weights.unionByName(change).groupBy("bucket").agg(F.sum("w").alias("w")).write.mode("overwrite").parquet(f"{path}/v={batch_id}")


def linear_accuracy(test: DataFrame, path: str, batch_id: int, key: str = "doc_id") -> float:
    weights = test.sparkSession.read.parquet(f"{path}/v={batch_id}")
    judged = test.select(key, "label").join(_margins(hashed_counts(test, key), weights, key), key, "left")
    hit = (F.coalesce("m", F.lit(0.0)) > 0) == (F.col("label") > 0)
    return judged.agg(F.avg(hit.cast("double"))).first()[0]


def bayes_update(batch: DataFrame, path: str, batch_id: int, key: str = "doc_id") -> None:
    """Add the batch to the class counts of multinomial naive Bayes; bucket -1 counts documents."""
    state = _version(batch.sparkSession, path, batch_id, "bucket bigint, label int, n bigint")
    labels = batch.select(key, F.col("label").cast("int").alias("label"))
    seen = hashed_counts(batch, key).join(labels, key).groupBy("bucket", "label").agg(F.sum("n").alias("n"))
    documents = labels.groupBy("label").agg(F.count("*").alias("n")).select(F.lit(-1).cast("bigint").alias("bucket"), "label", "n")
    state.unionByName(seen).unionByName(documents).groupBy("bucket", "label").agg(F.sum("n").alias("n")).write.mode("overwrite").parquet(f"{path}/v={batch_id}")


def bayes_accuracy(test: DataFrame, path: str, batch_id: int, key: str = "doc_id", alpha: float = 0.01, buckets: int = BUCKETS) -> float:
    """Share of test rows whose class has the highest score, over all classes in the state; ties go to the larger."""
    state = test.sparkSession.read.parquet(f"{path}/v={batch_id}")
    sizes = state.groupBy("label").agg(F.coalesce(F.sum(F.when(F.col("bucket") < 0, F.col("n"))), F.lit(0)).alias("docs"),
                                       F.coalesce(F.sum(F.when(F.col("bucket") >= 0, F.col("n"))), F.lit(0)).alias("words"))
    total = sizes.agg(F.sum("docs")).first()[0]
    counts = hashed_counts(test, key)
    lengths = test.select(key).join(counts.groupBy(key).agg(F.sum("n").alias("length")), key, "left").select(key, F.coalesce("length", F.lit(0)).alias("length"))
    # Every class starts from its prior and unseen words; words that it has seen add their gain.
    known = counts.join(state.where("bucket >= 0").withColumnRenamed("n", "seen"), "bucket").groupBy(key, "label").agg(
        F.sum(F.col("n") * F.log((F.col("seen") + alpha) / alpha)).alias("gain"))
    classes = sizes.agg(F.collect_list(F.struct("label", "docs", "words")).alias("classes")).first()["classes"]
    each = F.explode(F.array(*[F.struct(F.lit(c["label"]).alias("label"), F.lit(float(np.log(c["docs"] / total))).alias("prior"),
                                        F.lit(float(np.log(alpha / (c["words"] + alpha * buckets)))).alias("unseen")) for c in classes if c["docs"]]))
    scores = lengths.select(key, "length", each.alias("c")).select(key, F.col("c.label").alias("label"), (F.col("c.prior") + F.col("length") * F.col("c.unseen")).alias("base"))
    scores = scores.join(known, [key, "label"], "left").select(key, F.struct((F.col("base") + F.coalesce("gain", F.lit(0.0))).alias("s"), "label").alias("best"))
    judged = scores.groupBy(key).agg(F.max("best")["label"].alias("guess"))
    return test.select(key, "label").join(judged, key, "left").agg(F.avg((F.col("guess") == F.col("label")).cast("double"))).first()[0]


def record_progress(path: str, batch_id: int, values: dict, spark: SparkSession) -> None:
    """One metrics row per batch, replaced if the batch is repeated."""
    names = list(values)
    schema = ", ".join(f"{n} {'double' if isinstance(values[n], float) else 'string' if isinstance(values[n], str) else 'bigint'}" for n in names)
    spark.createDataFrame([tuple(values[n] for n in names)], schema).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def kmeans_step(batch: DataFrame, vector: str, path: str, batch_id: int, start: list[tuple]) -> None:
    """Mini-batch k-means: centres and their counts, one version per batch."""
    spark = batch.sparkSession
    centres, seen = start, {}
    if batch_id:
        rows = spark.read.parquet(f"{path}/v={batch_id - 1}").orderBy("cluster").collect()  # one row per centre
        centres, seen = [(r["cluster"], np.array(r["centre"])) for r in rows], {r["cluster"]: r["n"] for r in rows}
    centres, seen = minibatch_update(centres, seen, batch, vector)
    table = [(int(i), [float(x) for x in v], int(seen.get(i, 0))) for i, v in centres]
    spark.createDataFrame(table, "cluster int, centre array<double>, n bigint").write.mode("overwrite").parquet(f"{path}/v={batch_id}")
