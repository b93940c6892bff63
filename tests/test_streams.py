"""Streams: restart, late rows, failed messages."""

from pyspark.sql import functions as F

from millrace.session import scratch_path
from millrace.streaming import learning, logs, runs
from millrace.streaming.windows import halfhour_stream


def test_stream_continues_where_it_stopped(spark):
    folder, out, check = (scratch_path(spark, n) for n in ("in", "out", "check"))
    stream = lambda: runs.message_stream(spark, "text", {"path": folder})
    for part in (["a", "b"], ["c"]):
        spark.createDataFrame([(x,) for x in part], "value string").write.mode("append").text(folder)
        runs.run_to_files(stream(), out, check)
    runs.run_to_files(stream(), out, check)
    assert sorted(r["message"] for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_messages_that_cannot_be_read_are_marked(spark):
    lines = ["datetime id json_str note", '2024-01-02_03:04:05 7 {"type":"t","inner_json":"{\\"inner_value\\":\\"v\\"}"} x:"two words"', "2024-01-02_03:04:05 short",
             "2024-01-02_03:04:05 8 {broken x"]
    got = logs.parsed(spark.createDataFrame([(x,) for x in lines], "message string")).orderBy("id").collect()
    assert len(got) == 3
    by_id = {r["id"]: r for r in got}
    assert (by_id[7]["ext_type"], by_id[7]["inner_value"], by_id[7]["failed"]) == ("t", "v", False)
    assert by_id[None]["failed"] and by_id[8]["failed"]


def test_rows_behind_the_watermark_are_dropped(spark):
    folder, out, check = (scratch_path(spark, n) for n in ("in", "out", "check"))
    batches = [["2024-01-01 00:10:00", "2024-01-01 00:20:00", "2024-01-01 01:05:00"], ["2024-01-03 05:00:00"], ["2024-01-01 00:15:00", "2024-01-06 00:00:00"]]
    for times in batches:
        rows = spark.createDataFrame([(t,) for t in times], "t string").select(F.to_date("t").alias("dt"), F.to_timestamp("t").alias("ts"), F.lit(True).alias("tag"))
        rows.write.mode("append").parquet(folder)
        stream = runs.message_stream(spark, "parquet", {"path": folder}, "dt date, ts timestamp, tag boolean")
        runs.run_to_files(halfhour_stream(stream, "dt", "ts", "tag"), out, check)
    got = {str(r["bin"]): r["gt_30mins"] for r in spark.read.parquet(out).collect()}
    assert got == {"2024-01-01 00:00:00": 2, "2024-01-01 01:00:00": 1, "2024-01-03 05:00:00": 1}


def test_a_repeated_batch_replaces_its_own_state(spark):
    path = scratch_path(spark, "state")
    docs = spark.createDataFrame([(1, "good fine words", 1), (2, "bad poor words", 0)], "doc_id bigint, text string, label int")
    learning.bayes_update(docs, path, 0)
    once = sorted(map(tuple, spark.read.parquet(f"{path}/v=0").collect()))
    learning.bayes_update(docs, path, 0)
    assert sorted(map(tuple, spark.read.parquet(f"{path}/v=0").collect())) == once
    assert learning.bayes_accuracy(docs, path, 0) == 1.0
    linear = scratch_path(spark, "linear")
    for i in range(3):
        learning.linear_update(docs, linear, i, "perceptron")
    assert learning.linear_accuracy(docs, linear, 2) == 1.0
