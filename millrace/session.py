"""Session settings, the shared scratch folder and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join that feeds an aggregation on the same key is still split.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows hold whole texts; a batch of these must fit beside the work on it.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def local_session(cores: int | str = 8, name: str = "millrace") -> SparkSession:
    """A session for tests and the benchmark; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "20g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings every job here relies on."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a private one only in local mode."""
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder:
        return folder
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        context.setCheckpointDir(configured)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return os.path.join(scratch_root(spark), f"{label}-{uuid.uuid4().hex}")


def cut(df: DataFrame) -> DataFrame:
    """Write to the shared folder and go on from the files.

    A written table cuts the lineage like a reliable checkpoint does, and later readers get
    column pruning, compression and real sizes for the choice of joins.
    """
    path = scratch_path(df.sparkSession, "cut")
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes delete their shuffle files when they end, not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def drop_cut(*frames: DataFrame) -> None:
    """Delete the folders of cuts that nothing reads any more, such as a loop's last round."""
    for df in frames:
        for folder in {os.path.dirname(f) for f in df.inputFiles()}:
            if os.path.basename(folder).startswith("cut-"):
                path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def bounded_collect(df: DataFrame, limit: int, what: str) -> list:
    """Bring a table to the driver only if it has at most `limit` rows."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what}: more than {limit} rows, too large to hold in one place")
    return rows
