"""Sorts, limits, samples and set operations."""

from pyspark.sql import functions as F

from millrace.catalog import query
from millrace.functions.scalars import rounded
from millrace.operators import sampling as p
from millrace.operators import windows

H = "cast('0x' || substr(md5({}), 1, 15) as bigint)"


@query("order_by", "select o_orderkey, o_orderpriority, o_totalprice from orders order by o_orderpriority, o_totalprice desc, o_orderkey")
def _(t):
    return t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice").orderBy("o_orderpriority", F.desc("o_totalprice"), "o_orderkey")


@query("top_k", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10")
def _(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@query("trim_extremes", "select o_orderkey, o_totalprice from (select *, row_number() over (order by o_totalprice desc, o_orderkey) as rn from orders) x where rn > 2")
def _(t):
    return p.drop_extremes(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", "o_totalprice", 2)


@query("random_split", f"select o_orderkey, case when {H.format(chr(39) + '7:' + chr(39) + ' || cast(o_orderkey as varchar)')} / 1152921504606846976.0e0 < 0.7 then 'train' else 'test' end as part from orders")
def _(t):
    return p.split_by_hash(t.orders.select("o_orderkey"), "o_orderkey", 0.7, seed=7)


@query("bootstrap_sample", f"""
, n as (select id, row_number() over (order by id) as rn, count(*) over () as total from features_wide),
  d as (select range as draw from range(5000) where range < (select count(*) from features_wide))
select d.draw, n.id from d join n on n.rn = {H.format("'0:' || cast(d.draw as varchar)")} % n.total + 1""", "features_wide")
def _(t):
    return p.draw_with_replacement(t.features_wide.select("id"), "id", 5000)


@query("background_points", f"select point_id, {H.format(chr(39) + 'x13:' + chr(39) + ' || cast(point_id as varchar)')} % 100 as ix, {H.format(chr(39) + 'y13:' + chr(39) + ' || cast(point_id as varchar)')} % 80 as iy from points", "points")
def _(t):
    return p.random_cells(t.points, "point_id", 100, 80, 13)


@query("batch_ids", "select c_custkey, cast((row_number() over (order by c_custkey) - 1) // 100 as bigint) as batch_id from customer")
def _(t):
    return windows.with_batch_ids(t.customer.select("c_custkey"), ["c_custkey"], 100)


@query("union_augment", """
, s(shift, dr, dc) as (values ('same', 0, 0), ('up', -1, 0), ('down', 1, 0), ('left', 0, -1), ('right', 0, 1)), px as (select vec_id, label, i - 1 as i, embedding[i] as v from embeddings, range(1, 65) r(i)),
  moved as (select vec_id, label, shift, (i // 8 + dr) as r, (i % 8 + dc) as c, v from px, s)
select vec_id, label, shift, round(sum(v::double), 5) + 0.0 as total, round(sum(v::double * (r * 8 + c)), 4) + 0.0 as weighted from moved where r between 0 and 7 and c between 0 and 7 group by 1, 2, 3""")
def _(t):
    copies = p.shifted_copies(t.embeddings.select("vec_id", "label", "embedding"), "embedding", 8)
    as_double = F.col("embedding").cast("array<double>")
    total = F.aggregate(as_double, F.lit(0.0), lambda s, v: s + v)
    weighted = F.aggregate(F.transform(as_double, lambda v, i: v * i), F.lit(0.0), lambda s, v: s + v)
    return copies.select("vec_id", "label", "shift", rounded(total, 5).alias("total"), rounded(weighted, 4).alias("weighted"))


@query("distinct_values", "select p_brand, p_type, count(*) as n from part group by 1, 2 order by 1, 2")
def _(t):
    return t.part.groupBy("p_brand", "p_type").agg(F.count("*").alias("n")).orderBy("p_brand", "p_type")
