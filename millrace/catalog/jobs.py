"""Whole jobs."""

from pyspark.sql import functions as F

from millrace.catalog import query
from millrace.functions.scalars import rounded
from millrace.operators import geo
from millrace.operators.sampling import split_by_hash
from millrace.plans import feature_report, order_features, passengers, species, text_classify

K = "order_day"
_JSON = "json_extract_string(case when json_valid(estimate_snap) then estimate_snap end, '$.{0}')"
_RATES = "min(driver_add_rate) as {0}min_add_rate, min(customer_add_rate) as {0}min_bidding_rate, max(driver_add_rate) as {0}max_add_rate, max(customer_add_rate) as {0}max_bidding_rate"
_NAMES = ["min_add_rate", "min_bidding_rate", "max_add_rate", "max_bidding_rate"]
_PRICE = ("case when {0} is not distinct from 0 then coalesce(cast(trunc(cast(json_extract_string(case when json_valid(estimate_snap) then estimate_snap end, "
          "'$.estimate_price.\"' || cast(car_type_id as varchar) || '\"') as double)) as int), 0) else {0} end")
ORDER_SQL = f"""
, service_order as (select *, concat(dt, '/', service_order_id) as {K} from service_order_days), order_ext as (select *, concat(dt, '/', service_order_id) as {K} from order_ext_days),
  dispatch_detail as (select *, concat(dt, '/', service_order_id) as {K} from dispatch_days)
, cum as (select {K}, round, cast(sum(max(batch)) over (partition by {K} order by round) as bigint) as cum from dispatch_detail group by 1, 2),
  agg as (select {K}, max(round) as total_round, min(round) as init_round, min(dispatch_time) as first_dispatch_time, max(dispatch_time) as last_dispatch_time,
    coalesce(max(driver_add_rate), 0) as top_add, coalesce(max(customer_add_rate), 0) as top_bid from dispatch_detail group by 1),
  i0 as (select a.{K}, {_RATES.format('a_')} from agg a join dispatch_detail d on d.{K} = a.{K} and d.round = a.init_round group by 1),
  i1 as (select {K}, {_RATES.format('b_')} from dispatch_detail where round = 1 and batch = 1 group by 1),
  lastd as (select * from (select *, row_number() over (partition by {K}, driver_id order by round desc, batch desc, tie desc, distance desc, driver_add_rate desc, customer_add_rate desc) as rn from dispatch_detail) x where rn = 1),
  drv as (select {K}, count(driver_id) as sum_valid_driver, avg(distance) as mean_driver_distance from lastd group by 1),
  fa as (select * from (select {K}, round as r, batch as b, row_number() over (partition by {K} order by round, batch) as rn from dispatch_detail where accept_status = 1) x where rn = 1),
  far as (select fa.{K}, r, r - 1 as nr, case when r - 1 = 0 then b when r - 1 > 0 then b + cum end as fb from fa left join cum on cum.{K} = fa.{K} and cum.round = fa.r - 1),
  fav as (select fa.{K}, min(response_time) as first_response_time, {_RATES.format('c_')} from fa join dispatch_detail d on d.{K} = fa.{K} and d.round = fa.r where accept_status = 1 group by 1),
  na as (select far.{K}, max(driver_add_rate) as na_rate from far left join dispatch_detail d on d.{K} = far.{K} and d.round = far.nr group by 1),
  fb as (select * from (select {K}, round as br, batch as bb, customer_add_rate as brate, row_number() over (partition by {K} order by round, batch, customer_add_rate) as rn from dispatch_detail where customer_add_rate > 0) x where rn = 1),
  fbc as (select fb.{K}, br, brate, case when br = 1 then bb else cum + bb end as bbatch from fb left join cum on cum.{K} = fb.{K} and cum.round = fb.br - 1),
  accd as (select {K}, count(driver_id) as n, avg(distance) as m from (select *, row_number() over (partition by {K}, driver_id order by round desc, batch desc, tie desc, distance desc) as rn from dispatch_detail where accept_status = 1) x where rn = 1 group by 1),
  base as (select o.*, estimate_snap, coalesce(nullif(expect_end_time, 0), case when cast({_JSON.format('time_length')} as int) > 0 then expect_start_time + cast({_JSON.format('time_length')} as int) end) as e_end
    from service_order o left join order_ext e on o.{K} = e.{K} where o.{K} in (select {K} from dispatch_detail))
select o.service_order_id, user_id, o.driver_id, product_type_id, fixed_product_id, total_amount, start_time, end_time, expect_start_latitude, expect_start_longitude,
  coalesce(expect_end_latitude, cast({_JSON.format('end_latitude')} as double)) as expect_end_latitude, coalesce(expect_end_longitude, cast({_JSON.format('end_longitude')} as double)) as expect_end_longitude,
  expect_start_time, cast(isodow(epoch_ms(expect_start_time * 1000)) as int) as expect_start_day_of_week, cast(hour(epoch_ms(expect_start_time * 1000)) as int) as expect_start_hour_of_day,
  e_end as expect_end_time, cast(isodow(epoch_ms(e_end * 1000)) as int) as expect_end_day_of_week, cast(hour(epoch_ms(e_end * 1000)) as int) as expect_end_hour_of_day,
  cast({_JSON.format('distance')} as int) as predict_distance, car_type_id, case when flag is null or (flag & 2) = 2 then 'manual' else 'system' end as dispatch_type,
  round(case when l.distance > 0 then l.distance when l.distance is null or l.distance = 0 then mean_driver_distance else deadhead_distance end, 6) as deadhead_distance,
  {_PRICE.format('predict_origin_amount')} as predict_origin_amount, {_PRICE.format('predict_amount')} as predict_amount, order_status, cancel_reason_id, corporate_id, is_asap,
  case when (flag & 34359738368) = 34359738368 then 1 else 0 end as is_auto_dispatch, first_dispatch_time, last_dispatch_time, init_round,
  {', '.join(f'case when b_{n} > 0 then b_{n} else coalesce(a_{n}, 0) end as init_{n}' for n in _NAMES)},
  sum_valid_driver, round(mean_driver_distance, 6) as mean_driver_distance, coalesce(far.r, 0) as first_response_round, first_response_time,
  {', '.join(f'case when fav.{K} is not null then coalesce(c_{n}, 0) end as first_response_{n}' for n in _NAMES)},
  coalesce(far.nr, total_round) as max_no_accept_round, case when far.nr > 0 then coalesce(na_rate, 0) end as max_no_accept_max_add_rate, total_round,
  case when l.driver_add_rate > 0 then l.driver_add_rate else top_add end as final_add_rate, case when l.customer_add_rate > 0 then l.customer_add_rate else top_bid end as final_bidding_rate,
  ct.cum as total_batch, case when init_round = 1 then 1 else ci.cum + 1 end as init_batch, far.fb as first_response_batch,
  coalesce(case when far.nr <> 0 and far.fb > 1 then far.fb - 1 end, ct.cum) as max_no_accept_batch, coalesce(br, 0) as first_bidding_round, coalesce(bbatch, 0) as frist_bidding_batch, brate as frist_bidding_min_rate,
  coalesce(accd.n, 0) as sum_accept_driver, round(accd.m, 6) as mean_accept_driver_distance, create_time, actual_time_length, time_length, confirm_time, arrival_time, o.dt
from base o left join agg on agg.{K} = o.{K} left join i0 on i0.{K} = o.{K} left join i1 on i1.{K} = o.{K} left join drv on drv.{K} = o.{K} left join far on far.{K} = o.{K}
  left join fav on fav.{K} = o.{K} left join na on na.{K} = o.{K} left join fbc on fbc.{K} = o.{K} left join accd on accd.{K} = o.{K}
  left join lastd l on l.{K} = o.{K} and l.driver_id is not distinct from o.driver_id
  left join cum ct on ct.{K} = o.{K} and ct.round = agg.total_round left join cum ci on ci.{K} = o.{K} and ci.round = agg.init_round"""


@query("order_features", ORDER_SQL, "service_order_days order_ext_days dispatch_days")
def _(t):
    out = order_features.build(t.service_order_days, t.order_ext_days, t.dispatch_days)
    return out.withColumns({c: F.round(c, 6) for c in ("deadhead_distance", "mean_driver_distance", "mean_accept_driver_distance")})


@query("passenger_clean", """
select passenger_id, cast(dense_rank() over (order by sex) - 1 as int) as sex_val, case when coalesce(embarked, 'S') = 'C' then 1 else 0 end as "embarked_C", case when coalesce(embarked, 'S') = 'Q' then 1 else 0 end as "embarked_Q",
  case when coalesce(embarked, 'S') = 'S' then 1 else 0 end as "embarked_S", round(coalesce(fare, avg(fare) over ()), 6) as fare, round(coalesce(age, median(age) over (partition by sex, pclass)), 6) as age_fill,
  sibsp + parch as family_size, pclass from passengers""", "passengers")
def _(t):
    out = passengers.clean(t.passengers)
    return out.withColumn("fare", F.round("fare", 6)).withColumn("age_fill", F.round("age_fill", 6))


REPORT = """
, st as (select count(p_retailprice)::double as n, avg(p_retailprice) as mean, stddev_samp(p_retailprice) as std, min(p_retailprice) as min, max(p_retailprice) as max, quantile_cont(p_retailprice, 0.25) as q25,
    quantile_cont(p_retailprice, 0.5) as q50, quantile_cont(p_retailprice, 0.75) as q75 from features_wide),
  kept as (select * from (select *, row_number() over (order by p_size desc, id) as rn from features_wide where p_type is not null) x where rn > 2),
  out as (select 'profile' as step, name, value from st, lateral (values ('n', n), ('mean', mean), ('std', std), ('min', min), ('max', max), ('q25', q25), ('q50', q50), ('q75', q75)) v(name, value)
    union all select 'correlation', 'p_size', corr(p_size, p_retailprice) from features_wide union all select 'correlation', 'name_len', corr(name_len, p_retailprice) from features_wide
    union all select 'correlation', 'label', corr(label, p_retailprice) from features_wide
    union all select 'missing', c, case when c = 'age' then (select count(*) filter (where age is null) / count(*) from features_wide) else 0.0 end from (values ('id'), ('p_size'), ('p_retailprice'), ('age'), ('p_brand'), ('p_type'), ('name_len'), ('label')) m(c)
    union all select 'prepared', 'rows', count(*)::double from kept union all select 'prepared', 'log_mean', avg(ln(p_retailprice)) from kept)
select step, name, round(value, 6) + 0.0 as value from out"""


@query("feature_report", REPORT, "features_wide")
def _(t):
    from millrace.catalog.features import TYPES

    prepared = feature_report.prepare(t.features_wide, "id", "p_retailprice", "p_type", "p_size", 2, "p_type", TYPES)
    return feature_report.report(t.features_wide, prepared, "p_retailprice", ["p_size", "name_len", "label"]).withColumn("value", rounded(F.col("value"), 6))


@query("text_classify")
def _(t):
    marked = split_by_hash(t.labelled, "doc_id", 0.7)
    return text_classify.run(marked.where("part = 'train'"), marked.where("part = 'test'"))


@query("species_model")
def _(t):
    cells = t.places.groupBy(geo.grid_cell(F.col("lng"), 116.0, 0.1).alias("ix"), geo.grid_cell(F.col("lat"), 39.0, 0.1).alias("iy")).agg(
        F.avg("altitude").alias("altitude"), F.count("*").cast("double").alias("density"), F.avg(F.col("heading").cast("double")).alias("heading"))
    kinds = [r[0] for r in t.points.select("kind").distinct().orderBy("kind").collect()]
    return species.run(t.points.select("point_id", "kind", "lat", "lng"), cells, ["altitude", "density", "heading"], 116.0, 39.0, 0.1, 10, 10, kinds)
