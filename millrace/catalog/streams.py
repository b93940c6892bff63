"""Streams: each query lets its table arrive in slices and runs the stream until it is used up."""

from pyspark.sql import functions as F

from millrace.catalog import query
from millrace.catalog.projections import LOG_BODY
from millrace.operators import rows as r
from millrace.operators.features import as_doubles
from millrace.operators.sampling import split_by_hash
from millrace.session import scratch_path
from millrace.streaming import learning, logs, runs
from millrace.streaming.windows import halfhour_stream

PARSED = LOG_BODY + """, p as (select event_id, cast(try_strptime(replace(w[1], '_', ' '), '%Y-%m-%d %H:%M:%S') as timestamp) as event_time, case when len(w) = 4 then cast(w[2] as bigint) end as id,
  case when len(w) = 4 then json_extract_string(w[3], '$.type') end as ext_type, case when len(w) = 4 then json_extract_string(w[3], '$.version') end as ext_version,
  case when len(w) = 4 then case when json_extract_string(w[3], '$.inner_json') <> '-' then json_extract_string(json_extract_string(w[3], '$.inner_json'), '$.inner_value') else '-' end end as inner_value,
  len(w) <> 4 as failed from good)"""


def _log_stream(t, folder):
    return runs.message_stream(t.spark, "parquet", {"path": folder}, "event_id bigint, message string")


@query("stream_log_pipeline", PARSED + " select * from p", "log_lines")
def _(t):
    folder, out, check = (scratch_path(t.spark, n) for n in ("messages", "parsed", "check"))
    slices = runs.arrivals(t.log_lines, ["event_id"], 3)
    runs.play(slices, folder, lambda: runs.run_to_files(logs.parsed(_log_stream(t, folder), ["event_id"]), out, check))
    return t.spark.read.parquet(out).drop("message", "ext_color")


@query("stream_route", PARSED + " select case when failed then 'error' else 'csv' end as sink, strftime(event_time, '%Y%m%d') as day, count(*) as n from p group by 1, 2", "log_lines")
def _(t):
    folder, good, bad, check = (scratch_path(t.spark, n) for n in ("messages", "good", "bad", "check"))
    handle = lambda batch, batch_id: logs.route(logs.parsed(batch), good, bad, batch_id)
    runs.play(runs.arrivals(t.log_lines, ["event_id"], 2), folder, lambda: runs.run_batches(_log_stream(t, folder), handle, check))
    day = F.col("date").cast("string").alias("day")
    rows = t.spark.read.csv(good, schema="event_time string, id bigint, ext_type string, ext_version string, ext_color string, inner_value string, batch_id int, date string")
    errors = t.spark.read.schema("value string, batch_id int, date string").text(bad)
    counted = lambda df, sink: df.groupBy(F.lit(sink).alias("sink"), day).agg(F.count("*").alias("n"))
    return counted(rows, "csv").unionByName(counted(errors, "error"))


@query("stream_ingest", "select message as line from log_lines", "log_lines")
def _(t):
    folder, out, check = (scratch_path(t.spark, n) for n in ("tail", "stored", "check"))
    lines = [s.select(F.col("message").alias("value")) for s in runs.arrivals(t.log_lines, ["event_id"], 3)]
    stream = lambda: runs.message_stream(t.spark, "text", {"path": folder, "maxFilesPerTrigger": 2}).select(F.col("message").alias("line"))
    runs.play(lines, folder, lambda: runs.run_to_files(stream(), out, check), "text")
    return t.spark.read.parquet(out)


@query("stream_halfhour", """
select dt, time_bucket(interval 30 minutes, ts) as bin, count(*) filter (where not gt) as le_30mins, count(*) filter (where gt) as gt_30mins from
  (select dt, epoch_ms(create_s * 1000) as ts, start_s - create_s > 1800 as gt from intervals where create_s < start_s and start_s < end_s) x where cast(ts as date) = dt group by 1, 2""", "intervals")
def _(t):
    folder, out, check = (scratch_path(t.spark, n) for n in ("times", "bins", "check"))
    kept = t.intervals.where(r.in_order("create_s", "start_s", "end_s"))
    tagged = kept.select("dt", F.timestamp_seconds("create_s").alias("ts"), (F.col("start_s") - F.col("create_s") > 1800).alias("tag"), "id", "line")
    slices = [s.drop("id", "line") for s in runs.arrivals(tagged, ["ts", "id", "line", "tag", "dt"], 3)]
    # a heartbeat far ahead closes the last bins; its own bin stays open
    last = tagged.agg(F.max("ts").alias("ts")).select(F.to_date(F.lit("1970-01-01")).alias("dt"), (F.col("ts") + F.expr("interval 30 days")).alias("ts"), F.lit(True).alias("tag"))
    stream = lambda: halfhour_stream(runs.message_stream(t.spark, "parquet", {"path": folder}, "dt date, ts timestamp, tag boolean"), "dt", "ts", "tag")
    runs.play([*slices, last], folder, lambda: runs.run_to_files(stream(), out, check))
    return t.spark.read.parquet(out)


def _labelled_slices(t, docs, parts):
    return runs.arrivals(docs.select("doc_id", "text", "label"), ["doc_id"], parts)


DOCS = "doc_id bigint, text string, label int"


@query("stream_learn")
def _(t):
    folder, check, progress = (scratch_path(t.spark, n) for n in ("docs", "check", "progress"))
    kinds = {k: scratch_path(t.spark, k) for k in ("perceptron", "naive_bayes")}
    marked = split_by_hash(t.labelled, "doc_id", 0.7)
    test = marked.where("part = 'test'").select("doc_id", "text", "label").persist()
    n_test, n_test_pos = test.agg(F.count("*"), F.sum("label")).first()

    def handle(batch, batch_id):
        batch = batch.persist()
        n, positive = batch.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
        for kind, path in kinds.items():
            if kind == "naive_bayes":
                learning.bayes_update(batch, path, batch_id)
                score = learning.bayes_accuracy(test, path, batch_id)
            else:
                learning.linear_update(batch, path, batch_id, kind)
                score = learning.linear_accuracy(test, path, batch_id)
            learning.record_progress(f"{progress}/model={kind}", batch_id, {
                "n_train": n, "n_train_pos": positive, "n_test": n_test, "n_test_pos": n_test_pos, "accuracy": float(score)}, t.spark)
        batch.unpersist()

    stream = lambda: runs.message_stream(t.spark, "parquet", {"path": folder}, DOCS)
    runs.play(_labelled_slices(t, marked.where("part = 'train'"), 3), folder, lambda: runs.run_batches(stream(), handle, check))
    test.unpersist()
    return t.spark.read.parquet(progress)


@query("stream_minibatch_kmeans")
def _(t):
    folder, check, state = (scratch_path(t.spark, n) for n in ("vectors", "check", "centres"))
    rows = t.embeddings.select("vec_id", as_doubles("embedding").alias("v"))
    start = [(i, x["v"]) for i, x in enumerate(rows.orderBy("vec_id").limit(5).collect())]
    last = {"id": 0}

    def handle(batch, batch_id):
        learning.kmeans_step(batch, "v", state, batch_id, start)
        last["id"] = batch_id

    stream = lambda: runs.message_stream(t.spark, "parquet", {"path": folder}, "vec_id bigint, v array<double>")
    runs.play(runs.arrivals(rows, ["vec_id"], 4), folder, lambda: runs.run_batches(stream(), handle, check))
    return t.spark.read.parquet(f"{state}/v={last['id']}")


@query("stream_progress", """
, b as (select doc_id, label, length(text) > 1000 as guess, (row_number() over (order by doc_id) - 1) * 4 // count(*) over () as batch_id from labelled),
  g as (select batch_id, count(*) as n, sum(label) as pos, count(*) filter (where guess = (label = 1)) as hits from b group by 1)
select cast(batch_id as bigint) as batch, cast(sum(n) over w as bigint) as n_docs, cast(sum(pos) over w as bigint) as n_pos, round(sum(hits) over w / sum(n) over w, 6) as accuracy from g window w as (order by batch_id)""", "labelled")
def _(t):
    folder, check, progress = (scratch_path(t.spark, n) for n in ("docs", "check", "progress"))

    def handle(batch, batch_id):
        hit = (F.length("text") > 1000) == (F.col("label") == 1)
        n, positive, hits = batch.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0)), F.count_if(hit)).first()
        before = t.spark.read.parquet(f"{progress}/batch_id={batch_id - 1}").first() if batch_id else {"n_docs": 0, "n_pos": 0, "hits": 0}
        docs, right = before["n_docs"] + n, before["hits"] + hits
        learning.record_progress(progress, batch_id, {"batch": batch_id, "n_docs": docs, "n_pos": before["n_pos"] + positive, "hits": right, "accuracy": right / max(docs, 1)}, t.spark)

    stream = lambda: runs.message_stream(t.spark, "parquet", {"path": folder}, DOCS)
    runs.play(_labelled_slices(t, t.labelled, 4), folder, lambda: runs.run_batches(stream(), handle, check))
    return t.spark.read.parquet(progress).select("batch", "n_docs", "n_pos", F.round("accuracy", 6).alias("accuracy"))
