"""The given tables, and stand-in views over them for the jobs' input schemas.

Each view is one SQL text. `{epoch(x)}`-style differences between SQL dialects are
confined to the small dialect table below, so the same definition feeds Spark and the
SQL used for checking.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

DIALECT = {
    "spark": {"epoch": "unix_timestamp({0})", "str": "string"},
    "check": {"epoch": "cast(epoch({0}) as bigint)", "str": "varchar"},
}

VIEWS = {
    # one row per ride order
    "service_order": """
select o_orderkey as service_order_id, o_custkey as user_id, cast(o_orderkey % 97 as bigint) as driver_id,
  cast(o_custkey % 4 as int) as product_type_id, cast(o_custkey % 6 as int) as fixed_product_id,
  o_totalprice as total_amount,
  EPOCH[o_orderdate] + o_orderkey * 37 % 86400 + 600 as start_time,
  EPOCH[o_orderdate] + o_orderkey * 37 % 86400 + 600 + o_custkey % 3600 as end_time,
  39.0e0 + (o_custkey * 37 % 1000) / 1000.0e0 as expect_start_latitude,
  116.0e0 + (o_custkey * 91 % 1000) / 1000.0e0 as expect_start_longitude,
  case when o_orderkey % 4 = 1 then null else 39.0e0 + (o_orderkey * 53 % 1000) / 1000.0e0 end as expect_end_latitude,
  case when o_orderkey % 4 = 1 then null else 116.0e0 + (o_orderkey * 29 % 1000) / 1000.0e0 end as expect_end_longitude,
  EPOCH[o_orderdate] + o_orderkey * 37 % 86400 as expect_start_time,
  case when o_orderkey % 3 = 0 then null when o_orderkey % 3 = 1 then 0
       else EPOCH[o_orderdate] + o_orderkey * 37 % 86400 + 2700 end as expect_end_time,
  cast(o_orderkey % 4 as int) as car_type_id,
  cast(case when o_orderkey % 5 = 0 then null else o_orderkey % 8 + 34359738368 * (o_custkey % 2) end as bigint) as flag,
  case when o_orderkey % 7 = 0 then cast(null as double) else cast(o_custkey % 500 as double) end as deadhead_distance,
  case when o_orderstatus = 'F' then 0 else cast(floor(o_totalprice) as int) end as predict_origin_amount,
  case when o_orderstatus = 'F' then 0 else cast(floor(o_totalprice) as int) end as predict_amount,
  cast(case when o_orderstatus = 'F' then 7 when o_orderstatus = 'P' then 8 else 6 end as int) as order_status,
  cast(o_orderkey % 11 as int) as cancel_reason_id, cast(o_custkey % 2 as int) as is_asap,
  cast(o_custkey % 3 as bigint) as corporate_id,
  EPOCH[o_orderdate] + o_orderkey * 37 % 86400 - 120 as create_time,
  cast(o_orderkey % 5400 as bigint) as actual_time_length, cast(o_orderkey % 3600 as bigint) as time_length,
  EPOCH[o_orderdate] + o_orderkey * 37 % 86400 - 60 as confirm_time,
  EPOCH[o_orderdate] + o_orderkey * 37 % 86400 + 300 as arrival_time,
  cast(o_orderdate as date) as dt from orders""",
    # JSON estimates; open orders have no estimate row, some carry broken JSON
    "order_ext": """
select o_orderkey as service_order_id, cast(o_orderdate as date) as dt,
  case when o_orderpriority = '5-LOW' then concat('{"distance":', cast(o_custkey as STR))
  else concat('{"distance":', cast(o_custkey as STR), ',"time_length":', cast(o_orderkey % 3600 as STR),
  ',"end_latitude":', cast(o_orderkey % 90 as STR), '.25,"end_longitude":', cast(o_custkey % 180 as STR), '.5',
  ',"estimate_price":{"0":', cast(o_custkey % 90 as STR), '.5,"1":', cast(o_custkey % 70 as STR), '}}') end as estimate_snap
  from orders where o_orderstatus <> 'P'""",
    # one row per order, round, batch and driver
    "dispatch_detail": """
select l_orderkey as service_order_id, l_suppkey as driver_id, l_linenumber as round,
  cast(l_partkey % 3 + 1 as int) as batch, cast(floor(l_extendedprice) as int) % 9000 as distance,
  case when l_discount > 0 then l_discount end as driver_add_rate,
  case when l_tax > 0.04 then l_tax end as customer_add_rate,
  case when l_returnflag = 'A' then 1 else 0 end as accept_status,
  EPOCH[l_shipdate] + l_partkey % 86400 as dispatch_time,
  EPOCH[l_shipdate] + l_partkey % 86400 + l_suppkey % 60 as response_time, l_partkey as tie,
  concat('{"total_add_price_rate":', cast(l_discount as STR), ',"add_price_rate":', cast(l_tax as STR),
    ',"bidding_price":', cast(l_linenumber as STR), '}') as add_price_set from lineitem""",
    "log_lines": """
select event_id, case when event_id % 50 = 0 then 'datetime id json_str note'
  when event_id % 17 = 0 then concat(replace(substring(cast(ts as STR), 1, 19), ' ', '_'), ' broken ', event_type)
  else concat(replace(substring(cast(ts as STR), 1, 19), ' ', '_'), ' ', cast(event_id as STR), ' {"type":"', event_type,
   '","version":"', cast(user_id % 5 as STR), '"', case when event_id % 3 = 0 then ',"inner_json":"-"' when event_id % 3 = 1
   then concat(',"inner_json":"{\\\\"inner_value\\\\":\\\\"', cast(user_id as STR), '\\\\"}"') else '' end, '} x:"', event_type, ' seen here"') end as message from events""",
    "features_wide": """
select p_partkey as id, p_size, p_retailprice, case when p_size % 7 = 0 then null else cast(p_size as double) end as age,
  p_brand, p_type, cast(length(p_name) as int) as name_len, case when p_name like '%widget%' or p_size > 30 then 1 else 0 end as label
  from part""",
    "points": """
select c_custkey as point_id, 39.0e0 + (c_custkey * 37 % 1000) / 1000.0e0 as lat,
  116.0e0 + (c_custkey * 91 % 1000) / 1000.0e0 as lng, c_mktsegment as kind, c_acctbal as height from customer""",
    "places": """
select s_suppkey as place_id, 39.0e0 + (s_suppkey * 193 % 1000) / 1000.0e0 as lat,
  116.0e0 + (s_suppkey * 71 % 1000) / 1000.0e0 as lng, cast(s_nationkey % 8 as int) as heading, s_acctbal as altitude from supplier""",
    # consecutive lines of an order, one part per line number
    "links": """
select distinct a.p as src, b.p as dst from
  (select l_orderkey as o, l_linenumber as n, min(l_partkey) as p from lineitem group by l_orderkey, l_linenumber) a
  join (select l_orderkey as o, l_linenumber as n, min(l_partkey) as p from lineitem group by l_orderkey, l_linenumber) b
  on a.o = b.o and a.n + 1 = b.n""",
    # small parts are aliases: some point at their neighbour (and back), others down the list
    "redirects": """
select p_partkey as src, case when p_size <= 10 and p_partkey % 2 = 0 then p_partkey + 1
  when p_size <= 10 then p_partkey - 1 when p_partkey > p_size then p_partkey - p_size else p_partkey + p_size end as dst
  from part where p_size <= 25""",
    "prices": "select event_id, user_id, ts, value as price from events",
    "intervals": """
select l_orderkey as id, l_linenumber as line, cast(o_orderdate as date) as dt, o_orderdate as create_time, l_shipdate as start_time,
  o_orderpriority as city, EPOCH[o_orderdate] + l_partkey * 61 % 86400 as create_s,
  EPOCH[o_orderdate] + l_partkey * 61 % 86400 + l_suppkey * 97 % 4000 - 300 as start_s,
  EPOCH[o_orderdate] + l_partkey * 61 % 86400 + l_suppkey * 97 % 4000 - 300 + cast(l_quantity as bigint) * 60 as end_s
  from lineitem join orders on o_orderkey = l_orderkey""",
    # mail-like messages: headers, blank line, quoted line, body, signature
    "messages": """
select conv_id, turn, concat('From: ', role, chr(10), case when turn % 4 <> 3 then concat('Subject: Re ', role, ' ', cast(conv_id as STR), chr(10)) else '' end,
  'Lines: ', cast(length(text) as STR), chr(10), chr(10), case when turn % 2 = 1 then concat('somebody wrote:', chr(10), '> earlier words', chr(10)) else '' end,
  text, case when turn % 3 = 0 then concat(chr(10), '--', chr(10), role) else '' end) as message from conversations""",
    "addresses": """
select c_custkey, case when c_custkey % 5 < 3 then r_name end as province, case when c_custkey % 5 < 3 then n_name end as city,
  case when c_custkey % 5 < 2 then c_mktsegment end as district, case when c_custkey % 5 < 2 then concat('T', cast(c_nationkey as STR)) end as township,
  concat(r_name, n_name, c_mktsegment, case c_custkey % 5 when 3 then '街道' when 4 then '镇' else concat('T', cast(c_nationkey as STR)) end, c_name) as name
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "passengers": """
select c_custkey as passenger_id, case when c_custkey % 2 = 0 then 'female' else 'male' end as sex, case when c_custkey % 40 = 7 then null when c_nationkey < 5 then 'C' when c_nationkey < 10 then 'Q' else 'S' end as embarked,
  case when c_custkey % 50 = 3 then null else c_acctbal end as fare, case when c_custkey % 9 = 4 then null else cast(c_custkey * 7 % 80 as double) end as age,
  cast(c_nationkey % 3 + 1 as int) as pclass, cast(c_custkey % 4 as int) as parch, cast(c_custkey % 3 as int) as sibsp, c_name as name, c_mktsegment as cabin from customer""",
    # labelled documents; quality is the class
    "labelled": "select d.doc_id, d.text, d.lang, l.quality as label from documents d join labels l on d.doc_id = l.doc_id",
}

# The order tables by day: partly filled orders come again on the next day, with the details of their open lines.
_DAY = "cast(o_orderdate as date) as dt"
_AGAIN = "(select * from orders where o_orderstatus = 'P') o2"
for _name in ("service_order", "order_ext"):
    _again = VIEWS["service_order"] if _name == "service_order" else VIEWS["order_ext"].replace("where o_orderstatus <> 'P'", "")
    VIEWS[f"{_name}_days"] = VIEWS[_name] + " union all " + _again.replace(_DAY, _DAY.replace(" as dt", " + 1 as dt")).replace("from orders", f"from {_AGAIN}").strip()
VIEWS["dispatch_days"] = VIEWS["dispatch_detail"].replace(" from lineitem", f""",
  case when o_orderstatus = 'P' and l_linestatus = 'O' then cast(o_orderdate as date) + 1 else cast(o_orderdate as date) end as dt
  from lineitem join orders on o_orderkey = l_orderkey""")


def view_sql(name: str, dialect: str) -> str:
    words = DIALECT[dialect]
    text = VIEWS[name].strip()
    text = re.sub(r"EPOCH\[(\w+)\]", lambda m: words["epoch"].format(m.group(1)), text)
    text = re.sub(r"\bSTR\b", words["str"], text)
    if dialect == "check":
        text = text.replace("\\\\", "\\")
    return text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stand-in view as a lazy DataFrame over the parquet files."""
    text = view_sql(name, "spark")
    tag = re.sub(r"\W", "_", sf_dir)
    for t in TABLES:
        pattern = rf"\b(from|join) {t}\b"
        if re.search(pattern, text):
            registered = f"given{tag}_{t}"
            table(spark, sf_dir, t).createOrReplaceTempView(registered)
            text = re.sub(pattern, rf"\1 {registered}", text)
    return spark.sql(text)
