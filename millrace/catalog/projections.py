"""Projections, filters, and scalar functions."""

from pyspark.sql import functions as F

from millrace.catalog import query
from millrace.functions import scalars as s
from millrace.operators import rows


@query("project_cast", """
select service_order_id, cast(user_id as varchar) as rider, cast(floor(total_amount) as bigint) as amount, 0 as predict_distance, -1 as end_day,
  'hz' as city, cast(dt as timestamp) as day_start from service_order""", "service_order")
def _(t):
    return t.service_order.select(
        "service_order_id", F.col("user_id").cast("string").alias("rider"), F.floor("total_amount").alias("amount"),
        F.lit(0).alias("predict_distance"), F.lit(-1).alias("end_day"), F.lit("hz").alias("city"),
        F.col("dt").cast("timestamp_ntz").alias("day_start"))


@query("filter_compound", """
select id, line, dt, city, create_time, start_time from intervals
where dt between date '1997-01-01' and date '1999-12-31' and city in ('1-URGENT', '2-HIGH', '5-LOW') and start_time > create_time""", "intervals")
def _(t):
    return t.intervals.where(
        F.col("dt").between("1997-01-01", "1999-12-31") & F.col("city").isin("1-URGENT", "2-HIGH", "5-LOW") & (F.col("start_time") > F.col("create_time"))
    ).select("id", "line", "dt", "city", "create_time", "start_time")


@query("time_validity", """
select rule, rejected, total from (select count(*) as total, count(*) filter (where not create_s < end_s) as a, count(*) filter (where not create_s < start_s) as b,
  count(*) filter (where not (create_s < start_s and start_s < end_s)) as c from intervals) x, lateral (values ('end', a), ('start', b), ('kept', c)) v(rule, rejected)""", "intervals")
def _(t):
    return rows.rejects_per_rule(t.intervals, {
        "end": rows.in_order("create_s", "end_s"), "start": rows.in_order("create_s", "start_s"),
        "kept": rows.in_order("create_s", "start_s", "end_s")})


@query("default_nulls", """
select service_order_id, coalesce(expect_end_latitude, cast(json_extract_string(case when json_valid(estimate_snap) then estimate_snap end, '$.end_latitude') as double)) as end_lat,
  coalesce(nullif(expect_end_time, 0), case when cast(json_extract_string(case when json_valid(estimate_snap) then estimate_snap end, '$.time_length') as int) > 0
    then expect_start_time + cast(json_extract_string(case when json_valid(estimate_snap) then estimate_snap end, '$.time_length') as int) end) as end_time,
  coalesce(deadhead_distance, 0) as deadhead from service_order left join order_ext e using (service_order_id)""", "service_order order_ext")
def _(t):
    snap = F.col("estimate_snap")
    length = s.json_field(snap, "$.time_length", "int")
    return t.service_order.join(t.order_ext.drop("dt"), "service_order_id", "left").select(
        "service_order_id", F.coalesce("expect_end_latitude", s.json_field(snap, "$.end_latitude", "double")).alias("end_lat"),
        F.coalesce(rows.first_positive(F.col("expect_end_time")), F.when(length > 0, F.col("expect_start_time") + length)).alias("end_time"),
        F.coalesce("deadhead_distance", F.lit(0.0)).alias("deadhead"))


@query("positive_override", """
select service_order_id, round, driver_id, tie, case when customer_add_rate > 0 then customer_add_rate else coalesce(driver_add_rate, 0) end as rate,
  case when distance % 5 > 0 then cast(distance as double) when distance % 5 = 0 and driver_add_rate is null then 100.0e0 else 7.0e0 end as deadhead
  from dispatch_detail""", "dispatch_detail")
def _(t):
    rest = F.when(F.col("driver_add_rate").isNull(), 100.0).otherwise(7.0)
    last = F.when(F.col("distance") % 5 > 0, F.col("distance").cast("double"))
    return t.dispatch_detail.select(
        "service_order_id", "round", "driver_id", "tie",
        s.positive_or(F.col("customer_add_rate"), F.coalesce("driver_add_rate", F.lit(0.0))).alias("rate"),
        s.positive_or(last, rest).alias("deadhead"))


@query("flag_threshold", """
select id, line, start_s - create_s > 1800 as gt_30mins, case when start_s - create_s > 1800 then 1 else 0 end as tag from intervals""", "intervals")
def _(t):
    late = F.col("start_s") - F.col("create_s") > 1800
    return t.intervals.select("id", "line", late.alias("gt_30mins"), late.cast("int").alias("tag"))


@query("ratio_round", """
select o_orderpriority as week, round(sum(case when o_orderstatus = 'F' then 1 else 0 end) / count(*), 6) as complete_rate, round(avg(o_totalprice) / 100000, 1) as bidding
  from orders group by 1""")
def _(t):
    grouped = t.orders.groupBy("o_orderpriority").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("complete"), F.count("*").alias("total"), F.avg("o_totalprice").alias("price"))
    return (grouped.withColumn("complete_rate", rows.ratio(F.col("complete"), F.col("total"), 6))
            .withColumn("bidding", F.round(F.col("price") / 100000, 1)).drop("price", "complete", "total").withColumnRenamed("o_orderpriority", "week"))


@query("weekday_hour", """
select service_order_id, cast(isodow(epoch_ms(expect_start_time * 1000)) as int) as week, cast(hour(epoch_ms(expect_start_time * 1000)) as int) as hour,
  cast(isodow(epoch_ms(expect_end_time * 1000)) as int) as end_week, cast(hour(epoch_ms(expect_end_time * 1000)) as int) as end_hour from service_order""", "service_order")
def _(t):
    start, end = F.col("expect_start_time"), F.col("expect_end_time")
    return t.service_order.select("service_order_id", s.weekday_number(start).alias("week"), s.hour_of_day(start).alias("hour"),
                                  s.weekday_number(end).alias("end_week"), s.hour_of_day(end).alias("end_hour"))


@query("bit_flags", """
select service_order_id, case when flag is null or (flag & 2) = 2 then 'manual' else 'system' end as dispatch_type,
  case when (flag & 34359738368) = 34359738368 then 1 else 0 end as is_auto_dispatch from service_order""", "service_order")
def _(t):
    flag = F.col("flag")
    return t.service_order.select("service_order_id", s.dispatch_type(flag).alias("dispatch_type"), s.auto_dispatch(flag).alias("is_auto_dispatch"))


@query("json_paths", """
select service_order_id, driver_id, round, tie, cast(json_extract_string(add_price_set, '$.total_add_price_rate') as float) as total_rate,
  cast(json_extract_string(add_price_set, '$.bidding_price') as int) as bidding_price, cast(json_extract_string(add_price_set, '$.strategy_id') as int) as strategy_id,
  cast(json_extract_string(add_price_set, '$.total_add_price_rate') as float) - cast(json_extract_string(add_price_set, '$.add_price_rate') as float) as customer_rate
  from dispatch_detail""", "dispatch_detail")
def _(t):
    doc = F.col("add_price_set")
    total, own = s.json_field(doc, "$.total_add_price_rate", "float"), s.json_field(doc, "$.add_price_rate", "float")
    return t.dispatch_detail.select(
        "service_order_id", "driver_id", "round", "tie", total.alias("total_rate"), s.json_field(doc, "$.bidding_price", "int").alias("bidding_price"),
        s.json_field(doc, "$.strategy_id", "int").alias("strategy_id"), (total - own).alias("customer_rate"))


@query("json_map_lookup", """
select service_order_id, case when predict_amount is not distinct from 0
  then coalesce(cast(trunc(cast(json_extract_string(case when json_valid(estimate_snap) then estimate_snap end, '$.estimate_price."' || cast(car_type_id as varchar) || '"') as double)) as int), 0)
  else predict_amount end as predict_amount from service_order left join order_ext e using (service_order_id)""", "service_order order_ext")
def _(t):
    prices = F.get_json_object("estimate_snap", "$.estimate_price")
    return t.service_order.join(t.order_ext.drop("dt"), "service_order_id", "left").select(
        "service_order_id", F.when(F.col("predict_amount").eqNullSafe(0), s.price_from_json(prices, F.col("car_type_id")))
        .otherwise(F.col("predict_amount")).alias("predict_amount"))


LOG_BODY = r""", good as (select event_id, string_split_regex(trim(list_reduce(
    list_concat([message], list_transform(regexp_extract_all(message, ':"(?:[\w\\()-]+\s)+[\w\\()-]+"'), lambda q: q)),
    lambda text, q: replace(text, q, replace(q, ' ', '_')))), ' +') as w from log_lines where not contains(message, 'datetime'))"""


@query("nested_json_sentinel", LOG_BODY + """
select event_id, json_extract_string(w[3], '$.type') as ext_type, json_extract_string(w[3], '$.version') as ext_version,
  case when json_extract_string(w[3], '$.inner_json') <> '-' then json_extract_string(json_extract_string(w[3], '$.inner_json'), '$.inner_value') else '-' end as inner_value,
  case when json_extract_string(w[3], '$.inner_json') is null then 'nil' end as marker from good where len(w) = 4""", "log_lines")
def _(t):
    from millrace.streaming.logs import nested_value, tokenised

    doc = F.col("json_str")
    return tokenised(t.log_lines).where(~F.col("failed")).select(
        "event_id", F.get_json_object(doc, "$.type").alias("ext_type"), F.get_json_object(doc, "$.version").alias("ext_version"),
        nested_value(doc).alias("inner_value"), F.when(F.get_json_object(doc, "$.inner_json").isNull(), "nil").alias("marker"))


@query("log_tokenise", LOG_BODY + """
select event_id, w[1] as datetime, case when len(w) = 4 then w[2] end as id, case when len(w) = 4 then w[3] end as json_str,
  case when len(w) = 4 then w[4] end as note, len(w) <> 4 as failed from good""", "log_lines")
def _(t):
    from millrace.streaming.logs import tokenised

    return tokenised(t.log_lines).drop("message")


@query("epoch_to_local", """
select id, line, epoch_ms(create_s * 1000) + interval 8 hours as ts_create, epoch_ms(end_s * 1000) + interval 8 hours as ts_end from intervals""", "intervals")
def _(t):
    return t.intervals.select("id", "line", s.local_time(F.col("create_s")).alias("ts_create"), s.local_time(F.col("end_s")).alias("ts_end"))


@query("parse_event_time", """
select event_id, date_trunc('second', ts) as event_time, cast(null as timestamp) as bad_time from events""")
def _(t):
    text = F.replace(F.substring(F.col("ts").cast("string"), 1, 19), F.lit(" "), F.lit("_"))
    return t.events.select("event_id", s.event_time(text).alias("event_time"), s.event_time(F.concat(F.lit("x"), text)).alias("bad_time"))


@query("value_mapping", """
select o_orderkey, case month(o_orderdate) when 1 then 'Jan' when 2 then 'Feb' when 3 then 'Mar' when 4 then 'Apr' when 5 then 'May' when 6 then 'Jun' when 7 then 'Jul'
    when 8 then 'Aug' when 9 then 'Sep' when 10 then 'Oct' when 11 then 'Nov' else 'Dec' end as month_name,
  case o_orderpriority when '1-URGENT' then '1' when '2-HIGH' then '2' when '3-MEDIUM' then '3' else o_orderpriority end as level,
  case when o_custkey % 9 in (1, 2) then 1 when o_custkey % 9 in (3, 4) then 2 when o_custkey % 9 in (5, 6, 7) then 3 when o_custkey % 9 = 8 then 4 else 0 end as category from orders""")
def _(t):
    # fixed values: month names and category merges
    months = dict(enumerate("Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split(), start=1))
    levels = {"1-URGENT": "1", "2-HIGH": "2", "3-MEDIUM": "3"}
    merged = {1: 1, 2: 1, 3: 2, 4: 2, 5: 3, 6: 3, 7: 3, 8: 4}
    return t.orders.select(
        "o_orderkey", s.map_values(F.month("o_orderdate"), months).alias("month_name"),
        s.map_values(F.col("o_orderpriority"), levels).alias("level"),
        s.map_values((F.col("o_custkey") % 9).cast("int"), merged).alias("category"))


@query("math_features", """
select id, round(ln(p_retailprice), 6) as log_price, round(pow(p_size, 2), 6) as size_s2, round(pow(p_size, 3), 6) as size_s3, round(sqrt(p_size), 6) as size_sq,
  round(p_size * p_retailprice, 4) as grade, round(p_size + coalesce(age, 0), 4) as total from features_wide""", "features_wide")
def _(t):
    return t.features_wide.select(
        "id", s.rounded(F.log("p_retailprice"), 6).alias("log_price"), s.rounded(F.pow("p_size", F.lit(2)), 6).alias("size_s2"),
        s.rounded(F.pow("p_size", F.lit(3)), 6).alias("size_s3"), s.rounded(F.sqrt("p_size"), 6).alias("size_sq"),
        s.rounded(F.col("p_size") * F.col("p_retailprice"), 4).alias("grade"), s.rounded(F.col("p_size") + F.coalesce("age", F.lit(0.0)), 4).alias("total"))


@query("header_body_split", r""", cutm as (select conv_id, turn, split_part(message, chr(10) || chr(10), 1) as head,
    substring(message, strpos(message, chr(10) || chr(10)) + 2) as rest from messages),
  kept as (select conv_id, turn, head, array_to_string(list_filter(string_split(rest, chr(10)),
    lambda x: not regexp_matches(x, '(writes in|writes:|wrote:|says:|said:|^In article|^Quoted from|^\||^>)')), chr(10)) as k from cutm),
  trimmed as (select *, regexp_replace(k, '^\s+|\s+$', '', 'g') as tr from kept)
select conv_id, turn, regexp_extract(head, '(?m)^Subject:(.*)$', 1) as subject,
  case when regexp_matches(tr, '(?s)^(.*)\n[ \t\r]*-*[ \t\r]*(?:\n.*)?$') then regexp_extract(tr, '(?s)^(.*)\n[ \t\r]*-*[ \t\r]*(?:\n.*)?$', 1) else k end as body from trimmed""", "messages")
def _(t):
    m = F.col("message")
    return t.messages.select("conv_id", "turn", s.subject_line(m).alias("subject"), s.body_part(m).alias("body"))


@query("text_stats", """
select doc_id, length(text) as n_length, length(text) - length(replace(text, '.', '')) as n_sentences,
  round((select sum(strlen(text)) / 1e6 from documents), 6) as corpus_mb from documents""")
def _(t):
    size = t.documents.agg(F.sum(F.octet_length("text")) / 1e6).first()[0]
    text = F.col("text")
    return t.documents.select("doc_id", F.length(text).cast("bigint").alias("n_length"), F.regexp_count(text, F.lit(r"\.")).cast("bigint").alias("n_sentences"),
                              F.round(F.lit(size), 6).alias("corpus_mb"))


def _once(text, part):
    return f"case when length({part}) > 0 and strpos({text}, {part}) > 0 then substring({text}, 1, strpos({text}, {part}) - 1) || substring({text}, strpos({text}, {part}) + length({part})) else {text} end"


@query("strip_prefixes", f""", a1 as (select *, {_once('name', 'province')} as n1 from addresses), a2 as (select *, {_once('n1', 'city')} as n2 from a1),
  a3 as (select *, {_once('n2', 'district')} as n3 from a2), a4 as (select *, {_once('n3', 'township')} as n4 from a3)
select c_custkey, case when coalesce(province, city, district, township) is not null then n4 when strpos(name, '街道') > 1 then split_part(name, '街道', 2)
  when strpos(name, '镇') > 1 then split_part(name, '镇', 2) when strpos(name, '乡') > 1 then split_part(name, '乡', 2) else name end as short_name from a4""", "addresses")
def _(t):
    parts = [F.col(c) for c in ("province", "city", "district", "township")]
    return t.addresses.select("c_custkey", s.short_address(F.col("name"), parts).alias("short_name"))


@query("calendar_table", """
select cast(d as date) as day, strftime(d, '%Y%m%d') as dt, cast(epoch(d) as bigint) as day_start, cast(epoch(d) as bigint) + 86399 as day_end,
  cast(date_trunc('month', d) as date) as month_first, last_day(cast(d as date)) as month_last, cast(d as date) > cast(last as date) - 7 as in_last_7 from
  (select unnest(generate_series(min(o_orderdate), max(o_orderdate), interval 1 day)) as d, max(o_orderdate) as last from orders)""")
def _(t):
    first, last = t.orders.agg(F.min(F.to_date("o_orderdate")), F.max(F.to_date("o_orderdate"))).first()
    days = t.spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("day"))
    start = F.unix_timestamp(F.col("day").cast("timestamp"))
    return days.select("day", F.date_format("day", "yyyyMMdd").alias("dt"), start.alias("day_start"), (start + 86399).alias("day_end"),
                       F.trunc("day", "MM").alias("month_first"), F.last_day("day").alias("month_last"), (F.col("day") > F.date_sub(F.lit(last), 7)).alias("in_last_7"))


@query("upper_write", "select n_nationkey, n_name, upper(p_name) as upper_name, p_partkey from part join nation on n_nationkey = p_partkey % 25")
def _(t):
    from millrace.session import scratch_path

    path = scratch_path(t.spark, "upper")
    named = t.part.join(t.nation, F.col("n_nationkey") == F.col("p_partkey") % 25)
    named.select("n_nationkey", "n_name", F.upper("p_name").alias("upper_name"), "p_partkey").write.parquet(path)
    return t.spark.read.parquet(path)
