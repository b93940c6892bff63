"""Sources and sinks."""

from pyspark.sql import functions as F

from millrace.catalog import query
from millrace.session import scratch_path
from millrace.sources import delimited, markup, tables


@query("scan_partition", """
select service_order_id, user_id, total_amount from service_order where dt = (select max(dt) from service_order)""", "service_order")
def _(t):
    latest = t.service_order.agg(F.max("dt")).first()[0]
    return tables.scan_partition(t.service_order, "dt", latest, ["service_order_id", "user_id", "total_amount"])


@query("load_delimited", """
select o_orderkey as id, case when o_orderkey % 10 = 3 then null else o_totalprice end as price,
  case when o_orderkey % 10 <> 4 then o_custkey end as ext, o_orderpriority as note from orders""")
def _(t):
    path = scratch_path(t.spark, "tsv")
    text = t.orders.select(F.concat_ws(
        "\t", "o_orderkey", F.when(F.col("o_orderkey") % 10 == 3, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")),
        "o_orderpriority", F.when(F.col("o_orderkey") % 10 != 4, F.col("o_custkey"))).alias("value"))
    delimited.write_text(text, path)
    schema = delimited.schema_from_description("id bigint\nprice decimal(10,2)\nnote string\next int")
    return delimited.load_delimited(t.spark, path, schema)


@query("scan_csv_nulls", """
select id, age, p_brand, p_retailprice from features_wide""", "features_wide")
def _(t):
    path = scratch_path(t.spark, "csv")
    rows = t.features_wide.select("id", "age", "p_brand", "p_retailprice")
    rows.write.csv(path, header=True, nullValue="null")
    return delimited.scan_csv(t.spark, path, "id bigint, age double, p_brand string, p_retailprice double")


MONTH = "cast(year(o_orderdate) * 100 + month(o_orderdate) as int)"


@query("overwrite_partition", f"""
select o_orderkey, case when {MONTH} = (select max({MONTH}) from orders) then -o_totalprice else o_totalprice end as amount, {MONTH} as dt from orders""")
def _(t):
    path = scratch_path(t.spark, "orders")
    rows = t.orders.select("o_orderkey", F.col("o_totalprice").alias("amount"), F.expr(MONTH).alias("dt"))
    tables.write_partitions(rows, path, "dt")
    latest = rows.agg(F.max("dt")).first()[0]
    tables.write_partitions(rows.where(F.col("dt") == latest).withColumn("amount", -F.col("amount")), path, "dt")
    return t.spark.read.parquet(path).select("o_orderkey", "amount", F.col("dt").cast("int").alias("dt"))


@query("create_table", """
select o_orderkey, o_totalprice, cast(year(o_orderdate) as int) as dt from orders""")
def _(t):
    path = scratch_path(t.spark, "table")
    name = "loaded_" + path.rsplit("-", 1)[-1]
    tables.create_table(t.spark, name, "o_orderkey bigint, o_totalprice double, dt int", "dt", path, drop=True)
    rows = t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("dt"))
    years = [r[0] for r in rows.select("dt").distinct().orderBy("dt").limit(1).collect()]
    rows.hint("rebalance", "dt").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(name)
    tables.insert_partition(rows, name, "dt", years[0])
    return t.spark.table(name)


@query("export_delimited", "select o_orderkey, o_orderpriority, o_totalprice from orders")
def _(t):
    path = scratch_path(t.spark, "export")
    delimited.export_delimited(t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice"), path, "\t", ["o_orderkey"])
    return t.spark.read.csv(path, sep="\t", schema="o_orderkey bigint, o_orderpriority string, o_totalprice double")


@query("backfill_days", """
select cast(d as date) as dt, coalesce(n, 0) as n_rows from
  (select unnest(generate_series(min(cast(ts as date)), max(cast(ts as date)) + 5, interval 1 day)) as d from events) s
  left join (select cast(ts as date) as dt, count(*) as n from events group by 1) e on e.dt = cast(d as date)""")
def _(t):
    rows = t.events.select("event_id", "value", F.to_date("ts").alias("dt"))
    first, last = rows.agg(F.min("dt"), F.date_add(F.max("dt"), 5)).first()
    return tables.backfill_days(rows, scratch_path(t.spark, "days"), "dt", first, last)


@query("table_write_modes", """
select o_orderkey as id, cast(o_orderdate as date) as day from orders
union all select c_custkey as id, date '2000-01-01' as day from customer""")
def _(t):
    path = scratch_path(t.spark, "modes")
    name = "modes_" + path.rsplit("-", 1)[-1]
    first = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name"),
                            F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"))
    second = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit("2000-01-01").alias("date"))
    first.limit(0).write.mode("overwrite").option("path", path).saveAsTable(name)
    first.write.mode("append").saveAsTable(name)
    second.write.mode("append").saveAsTable(name)
    return t.spark.table(name).select("id", F.to_date("date", "yyyy-MM-dd").alias("day"))


@query("parameterised_sql", """
select o_orderpriority, count(*) as n, round(sum(o_totalprice), 2) as total from orders where o_totalprice > 250000 and o_orderstatus = 'F' group by 1""")
def _(t):
    return t.spark.sql(
        "select o_orderpriority, count(*) as n, round(sum(o_totalprice), 2) as total from {orders} "
        "where o_totalprice > :floor and o_orderstatus = :status group by o_orderpriority",
        args={"floor": 250000, "status": "F"}, orders=t.orders)


@query("query_preview", "select o_orderkey, o_custkey, o_totalprice from orders order by o_orderkey limit 100")
def _(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice").orderBy("o_orderkey").limit(100)


@query("parse_markup_docs", r"""
select page_id, regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1) as title,
  trim(regexp_replace(regexp_replace(regexp_extract(html, '(?s)<body[^>]*>(.*)', 1), '(?s)<!--.*?-->|<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) as body,
  array_to_string(regexp_extract_all(html, '<a [^>]*>([^<]*)</a>', 1), '|') as topics from pages""")
def _(t):
    return t.pages.select("page_id", markup.document_title(F.col("html")).alias("title"), markup.document_body(F.col("html")).alias("body"),
                          F.array_join(markup.document_topics(F.col("html")), "|").alias("topics"))


@query("scan_triples", """
select concat('Page_', cast(src as varchar)) as subject, 'linksTo' as predicate, concat('Page_', cast(dst as varchar)) as object from links""", "links")
def _(t):
    path = scratch_path(t.spark, "triples")
    base = "http://pages.example/resource/"
    uri = lambda c: F.concat(F.lit(f"<{base}Page_"), c, F.lit(">"))
    good = t.links.select(F.concat_ws(" ", uri(F.col("src")), F.lit(f"<{base}linksTo>"), uri(F.col("dst")), F.lit(".")).alias("value"))
    broken = t.redirects.select(F.concat_ws(" ", uri(F.col("src")), F.lit("# comment")).alias("value"))
    delimited.write_text(good.unionByName(broken), path)
    return delimited.scan_triples(t.spark, path, base)
