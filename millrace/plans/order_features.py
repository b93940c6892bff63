"""Order feature build: one row per ride order with what its dispatch rounds reveal.

Every step is keyed by (day, order), so an order seen on two days is two orders. The dispatch
details are scanned twice, each time with a combined aggregation: into one row per round, and
into one row per driver, which is written as three later steps read it. The running batch total
and the previous round come from a range-partitioned running total, so an order with very many
details never sits in one task. Everything else joins tables with one row per day and order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import scalars as s
from millrace.operators import joins
from millrace.operators.ordered import running
from millrace.operators.rows import first_positive
from millrace.session import cut
from millrace.sources.tables import write_partitions

# fixed values: output columns in table order; the partition column follows them
OUTPUT = """
service_order_id user_id driver_id product_type_id fixed_product_id total_amount start_time end_time expect_start_latitude
expect_start_longitude expect_end_latitude expect_end_longitude expect_start_time expect_start_day_of_week
expect_start_hour_of_day expect_end_time expect_end_day_of_week expect_end_hour_of_day predict_distance car_type_id
dispatch_type deadhead_distance predict_origin_amount predict_amount order_status cancel_reason_id corporate_id is_asap
is_auto_dispatch first_dispatch_time last_dispatch_time init_round init_min_add_rate init_min_bidding_rate
init_max_add_rate init_max_bidding_rate sum_valid_driver mean_driver_distance first_response_round first_response_time
first_response_min_add_rate first_response_min_bidding_rate first_response_max_add_rate first_response_max_bidding_rate
max_no_accept_round max_no_accept_max_add_rate total_round final_add_rate final_bidding_rate total_batch init_batch
first_response_batch max_no_accept_batch first_bidding_round frist_bidding_batch frist_bidding_min_rate sum_accept_driver
mean_accept_driver_distance create_time actual_time_length time_length confirm_time arrival_time
""".split()

KEY = "service_order_id"
DAY_KEYS = ("dt", KEY)
# (name, function, input column) of the four rate summaries every look-back needs
RATES = [("min_add_rate", F.min, "driver_add_rate"), ("min_bidding_rate", F.min, "customer_add_rate"),
         ("max_add_rate", F.max, "driver_add_rate"), ("max_bidding_rate", F.max, "customer_add_rate")]


# fixed value: the fields read from an extension row's JSON
ESTIMATE = "distance int, time_length int, end_latitude double, end_longitude double, estimate_price string"


def order_base(orders: DataFrame, ext: DataFrame) -> DataFrame:
    """Orders with calendar fields, flags and the estimates from their extension row.

    Joined by (day, order) like all that follows, so the rows are dealt out once; an order that
    lacks one of these has no estimates, and no details either.
    """
    one_ext = joins.one_per_key(ext.select(*DAY_KEYS, "estimate_snap"), list(DAY_KEYS))
    parsed = one_ext.select(*DAY_KEYS, F.from_json("estimate_snap", ESTIMATE).alias("est"))
    merged = orders.join(parsed, list(DAY_KEYS), "left")
    length = F.col("est.time_length")
    end = F.coalesce(first_positive(F.col("expect_end_time")), F.when(length > 0, F.col("expect_start_time") + length))
    merged = merged.withColumns({
        "predict_distance": F.col("est.distance"),
        "expect_end_latitude": F.coalesce("expect_end_latitude", "est.end_latitude"),
        "expect_end_longitude": F.coalesce("expect_end_longitude", "est.end_longitude"),
        "expect_end_time": end,
        "dispatch_type": s.dispatch_type(F.col("flag")),
        "is_auto_dispatch": s.auto_dispatch(F.col("flag")),
    })
    priced = {c: F.when(F.col(c).eqNullSafe(0), s.price_from_json(F.col("est.estimate_price"), F.col("car_type_id"))).otherwise(F.col(c))
              for c in ("predict_origin_amount", "predict_amount")}
    calendar = {}
    for side in ("start", "end"):
        calendar[f"expect_{side}_day_of_week"] = s.weekday_number(F.col(f"expect_{side}_time"))
        calendar[f"expect_{side}_hour_of_day"] = s.hour_of_day(F.col(f"expect_{side}_time"))
    return merged.withColumns({**priced, **calendar}).drop("est")


def round_table(details: DataFrame, keys: tuple[str, ...] = DAY_KEYS) -> DataFrame:
    """One row per (order, round) with everything later steps need, the running batch total
    and the previous round of the order."""
    accepted, first_wave = F.col("accept_status") == 1, (F.col("round") == 1) & (F.col("batch") == 1)
    sums = [F.max("batch").alias("batch"), F.min("dispatch_time").alias("first_time"), F.max("dispatch_time").alias("last_time"),
            F.min(F.when(accepted, F.col("batch"))).alias("accept_batch"), F.min(F.when(accepted, F.col("response_time"))).alias("accept_time"),
            F.min(F.when(F.col("customer_add_rate") > 0, F.struct("batch", "customer_add_rate"))).alias("bid")]
    for name, fn, column in RATES:
        sums.append(fn(column).alias(name))
        sums.append(fn(F.when(first_wave, F.col(column))).alias(f"wave_{name}"))
        sums.append(fn(F.when(accepted, F.col(column))).alias(f"accept_{name}"))
    rounds = details.groupBy(*keys, "round").agg(*sums)
    return running(rounds, list(keys), ["round"], {
        "cum_batch": ("sum", F.col("batch").cast("bigint"), True),
        "prev": ("max", F.struct(F.col("round").alias("round"), F.col("max_add_rate").alias("max_add_rate")), False)})


def _at_first(condition: Column | None, fields: dict[str, Column]) -> Column:
    """The fields of an order's first round that meets the condition."""
    row = F.struct("round", *[v.alias(k) for k, v in fields.items()])
    return F.min(row if condition is None else F.when(condition, row))


def order_summary(rounds: DataFrame, keys: tuple[str, ...] = DAY_KEYS) -> DataFrame:
    """Round table to one row per order."""
    has_prev = F.col("prev.round") == F.col("round") - 1
    before = F.when(has_prev, F.col("cum_batch") - F.col("batch"))
    accept = {"batch": F.col("accept_batch"), "before": before, "time": F.col("accept_time"),
              "prev_rate": F.when(has_prev, F.col("prev.max_add_rate"))}
    accept.update({n: F.col(f"accept_{n}") for n, _, _ in RATES})
    grouped = rounds.groupBy(*keys).agg(
        F.max("round").alias("total_round"), F.min("first_time").alias("first_dispatch_time"), F.max("last_time").alias("last_dispatch_time"),
        F.max("max_add_rate").alias("top_add_rate"), F.max("max_bidding_rate").alias("top_bidding_rate"),
        F.sum("batch").alias("total_batch"),
        _at_first(None, {"cum": F.col("cum_batch"), **{n: F.col(n) for n, _, _ in RATES}}).alias("init"),
        *[F.max(f"wave_{n}").alias(f"wave_{n}") for n, _, _ in RATES],
        _at_first(F.col("accept_batch").isNotNull(), accept).alias("acc"),
        _at_first(F.col("bid").isNotNull(), {"before": before, "batch": F.col("bid.batch"), "rate": F.col("bid.customer_add_rate")}).alias("bid"))
    none_before = F.col("acc.round") - 1
    answered = F.when(none_before == 0, F.col("acc.batch").cast("bigint")).when(none_before > 0, F.col("acc.batch") + F.col("acc.before"))
    out = {
        "init_round": F.col("init.round"),
        "init_batch": F.when(F.col("init.round") == 1, F.lit(1).cast("bigint")).otherwise(F.col("init.cum") + 1),
        "final_add_rate": F.coalesce("top_add_rate", F.lit(0.0)), "final_bidding_rate": F.coalesce("top_bidding_rate", F.lit(0.0)),
        "first_response_round": F.col("acc.round"), "first_response_time": F.col("acc.time"), "first_response_batch": answered,
        "max_no_accept_round": none_before,
        "max_no_accept_batch": F.when((none_before != 0) & (answered > 1), answered - 1),
        "max_no_accept_max_add_rate": F.when(none_before > 0, F.coalesce("acc.prev_rate", F.lit(0.0))),
        "first_bidding_round": F.col("bid.round"),
        "frist_bidding_batch": F.when(F.col("bid.round") == 1, F.col("bid.batch").cast("bigint")).otherwise(F.col("bid.before") + F.col("bid.batch")),
        "frist_bidding_min_rate": F.col("bid.rate"),
    }
    for n, _, _ in RATES:
        out[f"init_{n}"] = s.positive_or(F.col(f"wave_{n}"), F.coalesce(f"init.{n}", F.lit(0.0)))
        out[f"first_response_{n}"] = F.when(F.col("acc").isNotNull(), F.coalesce(f"acc.{n}", F.lit(0.0)))
    return grouped.select(*keys, "total_round", "total_batch", "first_dispatch_time", "last_dispatch_time", *[v.alias(k) for k, v in out.items()])


def batch_positions(details: DataFrame) -> DataFrame:
    """Batch positions counted across rounds, one row per order."""
    return order_summary(round_table(details, (KEY,)), (KEY,))


def last_driver_rows(details: DataFrame) -> DataFrame:
    """The latest detail of each (day, order, driver), and its latest accepted detail."""
    order = F.struct("round", "batch", "tie", "distance", "driver_add_rate", "customer_add_rate")
    last = details.groupBy(*DAY_KEYS, "driver_id").agg(
        F.max(order).alias("last"), F.max(F.when(F.col("accept_status") == 1, F.struct("round", "batch", "tie", "distance"))).alias("acc"))
    return last.select(*DAY_KEYS, "driver_id", F.col("last.distance").alias("final_distance"), F.col("last.driver_add_rate").alias("last_add_rate"),
                       F.col("last.customer_add_rate").alias("last_bidding_rate"), F.col("acc").isNotNull().alias("accepted"), F.col("acc.distance").alias("accept_distance"))


def build(orders: DataFrame, ext: DataFrame, details: DataFrame) -> DataFrame:
    """All feature columns for the orders that have dispatch details on their day's load."""
    drivers = cut(last_driver_rows(details))
    per_order = drivers.groupBy(*DAY_KEYS).agg(
        F.count("driver_id").alias("sum_valid_driver"), F.avg("final_distance").alias("mean_driver_distance"),
        F.count(F.when(F.col("accepted"), F.col("driver_id"))).alias("sum_accept_driver"), F.avg("accept_distance").alias("mean_accept_driver_distance"))
    # Few columns are dealt out by driver; the order's other columns wait for what its own driver did.
    own = joins.left_nullsafe(orders.select(*DAY_KEYS, "driver_id").distinct(), drivers.drop("accepted", "accept_distance").withColumn("_met", F.lit(True)), {k: k for k in (*DAY_KEYS, "driver_id")})
    own = own.where("_met").groupBy(*DAY_KEYS).agg(F.collect_list(F.struct("driver_id", "final_distance", "last_add_rate", "last_bidding_rate")).alias("own"))
    # One row per day and order with details: the first join also drops the orders without.
    out = order_base(orders, ext).join(per_order, list(DAY_KEYS))
    for table in (order_summary(round_table(details)), own):
        out = out.join(table, list(DAY_KEYS), "left")
    own = F.get(F.filter("own", lambda o: o["driver_id"].eqNullSafe(F.col("driver_id"))), F.lit(0))
    out = out.withColumn("own", own).withColumns({c: F.col(f"own.{c}") for c in ("final_distance", "last_add_rate", "last_bidding_rate")})
    distance = F.col("final_distance")
    out = out.withColumns({
        "deadhead_distance": F.when(distance > 0, distance.cast("double")).when(distance.isNull() | (distance == 0), F.col("mean_driver_distance"))
        .otherwise(F.col("deadhead_distance")),
        "final_add_rate": s.positive_or(F.col("last_add_rate"), F.col("final_add_rate")),
        "final_bidding_rate": s.positive_or(F.col("last_bidding_rate"), F.col("final_bidding_rate")),
        "max_no_accept_round": F.coalesce("max_no_accept_round", "total_round"),
        "max_no_accept_batch": F.coalesce("max_no_accept_batch", "total_batch"),
        "first_response_round": F.coalesce("first_response_round", F.lit(0)),
        "first_bidding_round": F.coalesce("first_bidding_round", F.lit(0)),
        "frist_bidding_batch": F.coalesce("frist_bidding_batch", F.lit(0).cast("bigint")),
        "sum_accept_driver": F.coalesce("sum_accept_driver", F.lit(0).cast("bigint")),
    })
    return out.select(*OUTPUT, "dt")


def run(orders: DataFrame, ext: DataFrame, details: DataFrame, path: str) -> DataFrame:
    """Build all days in one plan, replace exactly their partitions, and read the table back."""
    built = build(orders, ext, details)
    write_partitions(built, path, "dt")
    return built.sparkSession.read.schema(built.schema).parquet(path).select(*built.columns)
