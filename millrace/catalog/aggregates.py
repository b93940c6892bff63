"""Aggregations."""

from pyspark.sql import functions as F

from millrace.catalog import Inputs, query
from millrace.functions.scalars import rounded
from millrace.operators import aggregates as a
from millrace.operators import joins, ordered, rows
from millrace.session import prepare, scratch_path

BIN = "case when m < 5 then 5 when m < 10 then 10 when m < 20 then 20 when m < 30 then 30 when m < 60 then 60 when m < 120 then 120 when m < 240 then 240 when m < 360 then 360 when m < 600 then 600 else 10000 end"


@query("bucketize_count", f"""
select dt, city, {BIN} as label, count(*) as n from
  (select dt, city, (epoch(start_time) - epoch(create_time)) / 60 as m from intervals where start_time > create_time) x group by 1, 2, 3""", "intervals")
def _(t):
    return a.binned_waits(t.intervals)


@query("group_count", """
select dt, city, tag, count(*) as n from (select dt, city, case when start_s - create_s > 1800 then 1 else 0 end as tag from intervals) x group by 1, 2, 3 order by 1, 2, 3""", "intervals")
def _(t):
    tagged = t.intervals.withColumn("tag", F.when(F.col("start_s") - F.col("create_s") > 1800, 1).otherwise(0))
    return tagged.groupBy("dt", "city", "tag").agg(F.count("*").alias("n")).orderBy("dt", "city", "tag")


@query("group_minmax", """
select service_order_id, max(round) as total_round, min(round) as init_round, min(dispatch_time) as first_dispatch_time, max(dispatch_time) as last_dispatch_time,
  coalesce(max(driver_add_rate), 0) as final_add_rate, coalesce(max(customer_add_rate), 0) as final_bidding_rate from dispatch_detail group by 1""", "dispatch_detail")
def _(t):
    return t.dispatch_detail.groupBy("service_order_id").agg(
        F.max("round").alias("total_round"), F.min("round").alias("init_round"), F.min("dispatch_time").alias("first_dispatch_time"),
        F.max("dispatch_time").alias("last_dispatch_time"), F.coalesce(F.max("driver_add_rate"), F.lit(0.0)).alias("final_add_rate"),
        F.coalesce(F.max("customer_add_rate"), F.lit(0.0)).alias("final_bidding_rate"))


@query("group_count_mean", """
, last as (select service_order_id, driver_id, arg_max(distance, (round, batch, tie, distance)) as distance from dispatch_detail group by 1, 2)
select service_order_id, count(driver_id) as sum_valid_driver, round(avg(distance), 6) as mean_driver_distance from last group by 1""", "dispatch_detail")
def _(t):
    last = joins.last_per_key(t.dispatch_detail, ["service_order_id", "driver_id"], ["round", "batch", "tie"], ["distance"])
    return last.groupBy("service_order_id").agg(F.count("driver_id").alias("sum_valid_driver"), rounded(F.avg("distance"), 6).alias("mean_driver_distance"))


@query("filtered_group", """
select service_order_id, min(driver_add_rate) as min_add_rate, max(driver_add_rate) as max_add_rate, min(customer_add_rate) as min_bidding, max(customer_add_rate) as max_bidding
from dispatch_detail where round = 1 and batch = 1 group by 1""", "dispatch_detail")
def _(t):
    return t.dispatch_detail.where("round = 1 and batch = 1").groupBy("service_order_id").agg(
        F.min("driver_add_rate").alias("min_add_rate"), F.max("driver_add_rate").alias("max_add_rate"),
        F.min("customer_add_rate").alias("min_bidding"), F.max("customer_add_rate").alias("max_bidding"))


@query("group_having_ratio", """
select l_returnflag, l_linestatus, l_linenumber, l_tax, l_discount, cast(month(l_shipdate) as int) as m, cast(year(l_shipdate) as int) as y,
  round(sum(l_extendedprice * l_discount) / sum(l_extendedprice), 6) as rate from lineitem group by all having sum(l_quantity) > 10""")
def _(t):
    keys = ["l_returnflag", "l_linestatus", "l_linenumber", "l_tax", "l_discount", F.month("l_shipdate").alias("m"), F.year("l_shipdate").alias("y")]
    summed = t.lineitem.groupBy(*keys).agg(F.sum(F.col("l_extendedprice") * F.col("l_discount")).alias("part"),
                                           F.sum("l_extendedprice").alias("whole"), F.sum("l_quantity").alias("total"))
    return summed.where("total > 10").withColumn("rate", rows.ratio(F.col("part"), F.col("whole"), 6)).drop("part", "whole", "total")


@query("pivot_sum", """
select cast(o_orderdate as date) as dt, round(sum(o_totalprice) filter (where o_orderstatus = 'F'), 2) as f, round(sum(o_totalprice) filter (where o_orderstatus = 'O'), 2) as o,
  round(sum(o_totalprice) filter (where o_orderstatus = 'P'), 2) as p from orders group by 1""")
def _(t):
    wide = t.orders.groupBy(F.to_date("o_orderdate").alias("dt")).pivot("o_orderstatus", ["F", "O", "P"]).sum("o_totalprice")
    return wide.select("dt", *[F.round(c, 2).alias(c.lower()) for c in "FOP"])


@query("dedupe_keys", """
select l_partkey, l_suppkey, min(l_orderkey * 10 + l_linenumber) as first_line from lineitem group by 1, 2""")
def _(t):
    lines = t.lineitem.select("l_partkey", "l_suppkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("first_line"))
    return joins.one_per_key(lines, ["l_partkey", "l_suppkey"])


@query("latest_per_key", """
select service_order_id, round, batch, driver_id, distance from (select *, row_number() over (partition by service_order_id, round order by batch desc, tie desc, driver_id desc, distance desc) as rn from dispatch_detail) x where rn = 1""", "dispatch_detail")
def _(t):
    return joins.last_per_key(t.dispatch_detail, ["service_order_id", "round"], ["batch", "tie", "driver_id", "distance"], ["batch", "driver_id", "distance"])


@query("stage_counts", """
select 'orders' as stage, count(*) as n from service_order union all
select 'with_ext', count(*) from service_order o left join order_ext e on o.service_order_id = e.service_order_id union all
select 'with_rounds', count(*) from service_order o left join (select distinct service_order_id, round from dispatch_detail) d on o.service_order_id = d.service_order_id""",
       "service_order order_ext dispatch_detail")
def _(t):
    steps = a.StepCounter()
    main, t = t.spark, Inputs(prepare(t.spark.newSession()), t.sf_dir)
    orders = steps.watch(t.service_order.select("service_order_id"), "orders")
    extended = steps.watch(orders.join(t.order_ext.drop("dt"), "service_order_id", "left"), "with_ext")
    rounds = t.dispatch_detail.select("service_order_id", "round").distinct()
    final = steps.watch(extended.join(rounds, "service_order_id", "left"), "with_rounds")
    final.write.parquet(scratch_path(t.spark, "staged"))
    return main.createDataFrame(steps.counts(), "stage string, n bigint")


@query("describe", """
select name, count(v) as n, round(avg(v), 6) as mean, round(stddev_samp(v), 6) as std, round(min(v), 6) as min, round(max(v), 6) as max, round(quantile_cont(v, 0.25), 6) as q25,
  round(quantile_cont(v, 0.5), 6) as q50, round(quantile_cont(v, 0.75), 6) as q75 from
  (select 'l_extendedprice' as name, l_extendedprice as v from lineitem union all select 'l_quantity', l_quantity from lineitem union all select 'l_discount', l_discount from lineitem) x group by 1""")
def _(t):
    out = a.describe(t.lineitem, ["l_extendedprice", "l_quantity", "l_discount"])
    return out.select("name", "n", *[rounded(F.col(c), 6).alias(c) for c in out.columns if c not in ("name", "n")])


WIDE_COLUMNS = ["id", "p_size", "p_retailprice", "age", "p_brand", "p_type", "name_len", "label"]


@query("null_profile", ", x as (" + " union all ".join(
    f"select '{c}' as name, count(*) filter (where {c} is null) as total, count(*) as n from features_wide" for c in WIDE_COLUMNS) + ") select name, total, round(total / n, 6) as share from x", "features_wide")
def _(t):
    return a.null_profile(t.features_wide).withColumn("share", F.round("share", 6)).orderBy(F.desc("total"), "name")


@query("drop_sparse", "select id, p_size, p_retailprice, p_brand, p_type, name_len, label from features_wide where age is not null", "features_wide")
def _(t):
    complete = t.features_wide.where("age is not null").select("id")
    return rows.drop_sparse_columns(t.features_wide, 1).join(complete, "id", "left_semi")


NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_suppkey"]


@query("correlation_matrix", " union all ".join(
    f"select '{x}' as row_name, '{y}' as col_name, round(corr({x}, {y}), 6) + 0.0 as r from lineitem" for i, x in enumerate(NUMERIC) for y in NUMERIC[: i + 1]))
def _(t):
    return a.correlations(t.lineitem, NUMERIC).withColumn("r", rounded(F.col("r"), 6))


_ONCE = ", ".join(f"corr({x}, {y}) as c_{i}_{j}" for i, x in enumerate(NUMERIC) for j, y in enumerate(NUMERIC) if i < j)


@query("corr_topk", f", w as (select {_ONCE} from lineitem), m as (" + " union all ".join(
    f"select '{x}' as row_name, '{y}' as col_name, {'1.0' if i == j else f'c_{min(i, j)}_{max(i, j)}'} as r from w" for i, x in enumerate(NUMERIC) for j, y in enumerate(NUMERIC)) + """),
  top as (select col_name from m where row_name = 'l_extendedprice' order by r desc, col_name limit 3)
select row_name, col_name, round(r, 6) + 0.0 as r from m where row_name in (select * from top) and col_name in (select * from top)""")
def _(t):
    return a.most_correlated(t.lineitem, NUMERIC, "l_extendedprice", 3).withColumn("r", rounded(F.col("r"), 6))


@query("percentile_threshold", """
select l_returnflag, round(quantile_cont(l_extendedprice, 0.5), 4) as p50, round(quantile_cont(l_extendedprice, 0.9), 4) as p90 from lineitem group by 1""")
def _(t):
    out = ordered.quantiles(t.lineitem, ["l_returnflag"], "l_extendedprice", {"p50": 0.5, "p90": 0.9})
    return out.select("l_returnflag", rounded(F.col("p50"), 4).alias("p50"), rounded(F.col("p90"), 4).alias("p90"))


@query("halfhour_counts", """
, tagged as (select dt, epoch_ms(create_s * 1000) as ts, start_s - create_s > 1800 as gt from intervals where create_s < start_s and start_s < end_s),
  spine as (select dt, unnest(generate_series(cast(dt as timestamp), cast(dt as timestamp) + interval 1410 minutes, interval 30 minutes)) as bin from (select distinct dt from tagged)),
  c as (select dt, time_bucket(interval 30 minutes, ts) as bin, count(*) filter (where not gt) as le, count(*) filter (where gt) as gt from tagged where cast(ts as date) = dt group by 1, 2)
select s.dt, s.bin, coalesce(le, 0) as le_30mins, coalesce(gt, 0) as gt_30mins from spine s left join c on s.dt = c.dt and s.bin = c.bin""", "intervals")
def _(t):
    kept = t.intervals.where(rows.in_order("create_s", "start_s", "end_s"))
    tagged = kept.select("dt", F.timestamp_seconds("create_s").alias("ts"), (F.col("start_s") - F.col("create_s") > 1800).alias("tag"))
    return a.halfhour_counts(tagged, "dt", "ts", "tag")


def _bars(kind, year, part, src="prices"):
    at = "(ts, event_id)"
    return f"select '{kind}' as kind, {year} as year, {part} as part, arg_min(price, {at}) as open, max(price) as high, min(price) as low, arg_max(price, {at}) as close from {src} group by 2, 3"


@query("ohlc_resample", ", n as (select *, (row_number() over (order by ts, event_id) - 1) // 500 as stick from prices) " + " union all ".join([
    _bars("week", "cast(isoyear(ts) as bigint)", "cast(weekofyear(ts) as bigint)"), _bars("month", "cast(isoyear(ts) as bigint)", "cast(month(ts) as bigint)"),
    _bars("year", "cast(isoyear(ts) as bigint)", "cast(0 as bigint)"), _bars("rows", "cast(0 as bigint)", "cast(stick as bigint)", "n")]), "prices")
def _(t):
    iso = F.expr("extract(yearofweek from ts)").cast("bigint").alias("year")
    order = ["ts", "event_id"]
    zero = F.lit(0).cast("bigint")
    parts = {"week": F.weekofyear("ts").cast("bigint"), "month": F.month("ts").cast("bigint"), "year": zero}
    out = None
    for kind, part in parts.items():
        bars = a.price_bars(t.prices, [iso, part.alias("part")], order, "price").withColumn("kind", F.lit(kind))
        out = bars if out is None else out.unionByName(bars)
    every = a.bars_every(t.prices, 500, order, "price").withColumnRenamed("stick", "part").withColumn("year", zero).withColumn("kind", F.lit("rows"))
    return out.unionByName(every)


@query("category_share", """
select l_returnflag, l_linenumber, n, round(share, 6) as share, rank from (select l_returnflag, l_linenumber, count(*) as n, count(*) / sum(count(*)) over (partition by l_returnflag) as share,
  row_number() over (partition by l_returnflag order by count(*) desc, l_linenumber) as rank from lineitem group by 1, 2) x where rank <= 3""")
def _(t):
    return a.top_shares(t.lineitem, "l_returnflag", "l_linenumber", 3).withColumn("share", F.round("share", 6))
