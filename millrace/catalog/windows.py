"""Window-style operators."""

from pyspark.sql import functions as F

from millrace.catalog import query
from millrace.functions.scalars import rounded
from millrace.operators import windows as w

CUM = """
, base as (select service_order_id, round, max(batch) as batch from dispatch_detail group by 1, 2),
  cum as (select service_order_id, round, batch, cast(sum(batch) over (partition by service_order_id order by round) as bigint) as cum_batch from base)"""


@query("running_sum", CUM + " select service_order_id, round, cum_batch from cum", "dispatch_detail")
def _(t):
    return w.batches_per_round(t.dispatch_detail).select("service_order_id", "round", "cum_batch")


@query("cumulative_lookup", CUM + """,
  agg as (select service_order_id, min(round) as init_round, max(round) as total_round from base group by 1),
  acc as (select service_order_id, arg_min(round, (round, batch)) as r, arg_min(batch, (round, batch)) as b from dispatch_detail where accept_status = 1 group by 1)
select a.service_order_id, c1.cum_batch as total_batch, case when a.init_round = 1 then 1 else c2.cum_batch + 1 end as init_batch,
  case when acc.r = 1 then acc.b else acc.b + c3.cum_batch end as first_response_batch
from agg a left join cum c1 on c1.service_order_id = a.service_order_id and c1.round = a.total_round
  left join cum c2 on c2.service_order_id = a.service_order_id and c2.round = a.init_round
  left join acc on acc.service_order_id = a.service_order_id
  left join cum c3 on c3.service_order_id = a.service_order_id and c3.round = acc.r - 1""", "dispatch_detail")
def _(t):
    from millrace.plans.order_features import batch_positions

    return batch_positions(t.dispatch_detail).select("service_order_id", "total_batch", "init_batch", "first_response_batch")


@query("group_median_fill", """
select id, round(coalesce(age, median(age) over (partition by p_brand, label)), 6) as age_fill from features_wide""", "features_wide")
def _(t):
    return w.fill_group_median(t.features_wide, ["p_brand", "label"], "age", "age_fill").select("id", rounded(F.col("age_fill"), 6).alias("age_fill"))


@query("rank_results", """
select * from (select l_suppkey, score, cast(rank() over (order by score desc) as int) as rank from (select l_suppkey, round(avg(l_quantity), 1) as score from lineitem group by 1) x) y where rank <= 10""")
def _(t):
    scores = t.lineitem.groupBy("l_suppkey").agg(F.round(F.avg("l_quantity"), 1).alias("score"))
    return w.top_with_ties(scores, "score", 10)
