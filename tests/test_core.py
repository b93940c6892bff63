"""Ordered helpers, joins, sources and the order features on small hand-made inputs."""

import os
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace import session
from millrace.functions import scalars, tails
from millrace.operators import aggregates, joins, ordered, rows, sampling, windows
from millrace.plans import order_features
from millrace.session import bounded_collect, scratch_path
from millrace.sources import delimited, tables


def test_running_totals_with_a_hot_key(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"k": np.where(np.arange(3000) % 3 == 0, 7, rng.integers(0, 200, 3000)), "o": rng.permutation(3000), "v": rng.integers(-5, 9, 3000)})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    out = ordered.running(spark.createDataFrame(pdf), ["k"], ["o"], {"upto": ("sum", F.col("v"), True), "before": ("sum", F.col("v"), False), "top": ("max", F.col("v"), False)})
    got = out.toPandas().sort_values(["k", "o"]).reset_index(drop=True)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = pdf.sort_values(["k", "o"]).reset_index(drop=True)
    upto = want.groupby("k")["v"].cumsum()
    assert (got["upto"] == upto).all()
    before = (upto - want["v"]).where(want.groupby("k").cumcount() > 0)
    assert np.array_equal(got["before"].to_numpy(float), before.to_numpy(float), equal_nan=True)
    top = want.groupby("k")["v"].cummax().groupby(want["k"]).shift()
    assert np.array_equal(got["top"].to_numpy(float), top.to_numpy(float), equal_nan=True)


def test_row_numbers_and_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", 4), ("b", 5)], "k string, o int")
    got = {(r["k"], r["o"]): r["n"] for r in ordered.number_rows(df, ["o"], "n", ["k"]).collect()}
    assert got == {(None, 1): 1, (None, 2): 2, ("a", 3): 1, ("a", 4): 2, ("b", 5): 1}


def test_quantiles_match_numpy(spark):
    values = np.random.default_rng(1).integers(0, 50, 997).astype(float)
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    got = ordered.quantiles(df, [], "v", {"a": 0.1, "b": 0.5, "c": 0.93}).first()
    assert [got["a"], got["b"], got["c"]] == pytest.approx(list(np.quantile(values, [0.1, 0.5, 0.93])))


def test_null_safe_left_join_keeps_rows(spark):
    left = spark.createDataFrame([(1,), (None,), (3,)], "k int")
    right = spark.createDataFrame([(1, "a"), (None, "n")], "k int, v string")
    out = joins.left_nullsafe(left, right, {"k": "k"})
    assert {(r["k"], r["v"]) for r in out.collect()} == {(1, "a"), (None, "n"), (3, None)}
    assert "NestedLoop" not in out._jdf.queryExecution().toString()


def test_wait_bins(spark):
    df = spark.createDataFrame([(None,), (-3.0,), (4.9,), (5.0,), (600.0,)], "m double")
    assert [r[0] for r in df.select(aggregates.wait_bin(F.col("m"))).collect()] == [-1, 5, 5, 10, 10000]


def test_strict_time_order(spark):
    df = spark.createDataFrame([(1, 2), (2, 2), (3, 2), (None, 2)], "a int, b int")
    assert [r[0] for r in df.select(rows.in_order("a", "b")).collect()] == [True, False, False, False]


def test_json_price_lookup(spark):
    df = spark.createDataFrame([('{"3": 12.9}', 3), ('{"3": 12.9}', 4), ("oops", 3), (None, 3), ('{"3": null}', 3)], "j string, i int")
    assert [r[0] for r in df.select(scalars.price_from_json(F.col("j"), F.col("i"))).collect()] == [12, 0, 0, 0, 0]


def test_remove_once_and_signature(spark):
    df = spark.createDataFrame([("abcabc", "b"), ("abc", None), ("a.c", ".")], "t string, p string")
    assert [r[0] for r in df.select(scalars.remove_once(F.col("t"), F.col("p"))).collect()] == ["acabc", "abc", "ac"]
    message = "From: x\nSubject:  hi\n\nA wrote:\n> old\nnew text\nmore\n--\nname"
    row = spark.createDataFrame([(message,)], "m string").select(scalars.subject_line(F.col("m")), scalars.body_part(F.col("m"))).first()
    assert tuple(row) == ("  hi", "new text\nmore")


def test_loader_keeps_bad_rows(spark):
    path = scratch_path(spark, "tsv")
    spark.createDataFrame([("1\t2.5\tx",), ("bad\t7\ty",), ("3",)], "value string").write.text(path)
    schema = delimited.schema_from_description("id bigint\nprice decimal(9,2)\nname string")
    got = {tuple(r) for r in delimited.load_delimited(spark, path, schema).collect()}
    assert got == {(1, 2.5, "x"), (None, 7.0, "y"), (3, None, None)}


def test_partition_scan_prunes(spark):
    path = scratch_path(spark, "parts")
    tables.write_partitions(spark.range(100).select("id", (F.col("id") * 2).alias("v"), (F.col("id") % 4).cast("int").alias("dt")), path, "dt")
    scan = tables.scan_partition(spark.read.parquet(path), "dt", 2, ["id"])
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert scan.count() == 25 and "PartitionFilters: [isnotnull(dt" in plan and "ReadSchema: struct<id:bigint>" in plan


def test_overwrite_leaves_other_partitions(spark):
    path = scratch_path(spark, "parts")
    df = spark.createDataFrame([(1, 1), (2, 2)], "v int, dt int")
    tables.write_partitions(df, path, "dt")
    tables.write_partitions(spark.createDataFrame([(9, 2)], "v int, dt int"), path, "dt")
    assert {tuple(r) for r in spark.read.parquet(path).select("v", "dt").collect()} == {(1, 1), (9, 2)}


def test_folds_are_even_and_repeatable(spark):
    df = spark.range(103).withColumn("label", (F.col("id") % 2).cast("int"))
    first = {r["id"]: r["fold"] for r in sampling.folds(df, "id", 5, "label").collect()}
    second = {r["id"]: r["fold"] for r in sampling.folds(df.repartition(7), "id", 5, "label").collect()}
    assert first == second
    sizes = pd.Series(first).value_counts()
    assert sizes.max() - sizes.min() <= 2


def test_top_with_ties(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", 4.0), ("c", 4.0), ("d", 3.0), ("e", 1.0)], "n string, s double")
    assert {(r["n"], r["rank"]) for r in windows.top_with_ties(df, "s", 2).collect()} == {("a", 1), ("b", 2), ("c", 2)}


def test_tail_probabilities():
    assert tails.chi2_tail(3.841458820694124, 1) == pytest.approx(0.05, rel=1e-9)
    assert tails.chi2_tail(18.307038053275146, 10) == pytest.approx(0.05, rel=1e-9)
    assert tails.f_tail(4.964602743730711, 1, 10) == pytest.approx(0.05, rel=1e-7)
    assert tails.r_tail(0.0, 20) == pytest.approx(1.0)


def test_bounded_collect_refuses_more(spark):
    with pytest.raises(ValueError):
        bounded_collect(spark.range(11), 10, "rows")


def test_order_features_edge_cases(spark):
    spec = "service_order_id bigint, driver_id bigint, round int, batch int, distance int, driver_add_rate double, customer_add_rate double, accept_status int, dispatch_time bigint, response_time bigint, tie bigint"
    details = spark.createDataFrame([
        (1, 10, 2, 1, 100, 0.1, None, 0, 5, 6, 1), (1, 10, 2, 3, 0, None, 0.2, 0, 7, 8, 2), (1, 11, 3, 2, 50, 0.4, 0.3, 1, 9, 10, 3),
        (2, 20, 1, 1, 30, None, None, 0, 1, 2, 4), (2, 21, 3, 2, 40, None, None, 1, 3, 4, 5)], spec)
    got = {r["service_order_id"]: r for r in order_features.batch_positions(details).collect()}
    one, two = got[1], got[2]
    # starts in round 2: the initial batch is one behind the round's own total
    assert (one["init_round"], one["init_batch"], one["total_batch"]) == (2, 4, 5)
    # accepted in round 3, batch 2, after three batches in round 2
    assert (one["first_response_batch"], one["max_no_accept_batch"], one["max_no_accept_max_add_rate"]) == (5, 4, 0.1)
    # first bid in round 2, whose previous round is not there
    assert (one["first_bidding_round"], one["frist_bidding_batch"]) == (2, None)
    # round 2 is missing, so the batch position cannot be told
    assert (two["first_response_round"], two["first_response_batch"], two["max_no_accept_max_add_rate"]) == (3, None, 0.0)


def test_order_features_keep_one_row_per_day_and_order(spark, given):
    orders, details = given.service_order_days, given.dispatch_days
    out = order_features.build(orders, given.order_ext_days, details)
    want = orders.join(details, ["dt", "service_order_id"], "left_semi").count()
    assert len(order_features.OUTPUT) == 63 and out.count() == want
    assert out.select("service_order_id").distinct().count() < want  # some orders come on two days


def test_order_features_run_replaces_only_its_days(spark, given, tmp_path):
    days = [r[0] for r in given.service_order_days.select("dt").distinct().orderBy("dt").limit(5).collect()]
    some = lambda df, k: df.where(df["dt"].isin(days[:k] if k > 0 else days[k:]))
    path, tables = str(tmp_path / "orders"), (given.service_order_days, given.order_ext_days, given.dispatch_days)
    whole = order_features.run(*[some(df, 5) for df in tables], path)
    before = sorted(map(str, whole.collect()))
    assert before == sorted(map(str, order_features.build(*[some(df, 5) for df in tables]).collect())) and before
    again = order_features.run(*[some(df, -2) for df in tables], path)
    assert sorted(map(str, again.collect())) == before


def test_order_features_scan_details_twice(spark, given):
    seen = []
    original = order_features.cut
    order_features.cut = lambda df: seen.append(df._jdf.queryExecution().optimizedPlan().toString()) or original(df)
    try:
        out = order_features.build(given.service_order_days, given.order_ext_days, given.dispatch_days)
    finally:
        order_features.cut = original
    plans = [*seen, out._jdf.queryExecution().optimizedPlan().toString()]
    # the round table is written inside the running total, the driver table here
    assert sum(p.count("l_extendedprice") > 0 for p in plans) <= 2


@pytest.mark.parametrize("name", ["order_features", "join_left_nullsafe", "join_left_composite", "halfhour_counts", "radius_join", "nearest_codebook", "roc_mean", "tfidf", "running_sum"])
def test_plans_have_no_pair_joins_and_no_single_task_windows(spark, name):
    from conftest import SF_DIR

    from millrace import catalog

    catalog.load_all()
    plan = catalog.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    lines = plan.split("\n")
    for i, line in enumerate(lines):
        if "Window [" in line and any("SinglePartition" in x for x in lines[i + 1:i + 4]):
            assert "_b#" in line  # only the totals of whole partitions meet in one place


def test_moments_keep_their_digits_around_a_large_mean(spark):
    """Mean 1e6 and unit variance, as a whole, per group and in the F statistic."""
    import numpy as np
    import pandas as pd

    from millrace.operators import moments, selection

    rng = np.random.default_rng(8)
    x, g = rng.normal(0, 1, (600, 3)), rng.integers(0, 4, 600)
    x[:, 1] += g * 0.3
    df = spark.createDataFrame(pd.DataFrame({"v": list(x + 1e6), "g": g, "a": x[:, 0] + 1e6, "b": x[:, 1] + 1e6})).repartition(7)
    assert np.allclose(moments.moments(df, "v").covariance(), np.cov(x.T), rtol=1e-6, atol=1e-8)
    groups = moments.grouped_moments(df, "v", "g")
    for c in range(4):
        assert groups[c].n == (g == c).sum() and np.allclose(groups[c].covariance(), np.cov(x[g == c].T), rtol=1e-6, atol=1e-8)
    joined = groups[0] + groups[1]
    assert np.allclose(joined.covariance(), np.cov(x[g < 2].T), rtol=1e-6, atol=1e-8) and np.allclose(joined.mean, x[g < 2].mean(axis=0) + 1e6)
    for r in selection.anova_f(df, ["a", "b"], "g").collect():
        y = x[:, 0 if r["name"] == "a" else 1]
        within = sum(((y[g == c] - y[g == c].mean()) ** 2).sum() for c in range(4))
        between = sum((g == c).sum() * (y[g == c].mean() - y.mean()) ** 2 for c in range(4))
        assert abs(r["f"] / ((between / 3) / (within / 596)) - 1) < 1e-6


def test_order_features_deal_orders_out_once(spark, given):
    """Also with days, orders and drivers that are missing or come twice."""
    orders = given.service_order_days
    odd = orders.limit(40).withColumn("driver_id", F.lit(None).cast("bigint")).unionByName(orders.limit(30).withColumn("dt", F.lit(None).cast("date"))).unionByName(orders.limit(20))
    details = given.dispatch_days
    met = details.withColumn("driver_id", F.pmod("service_order_id", F.lit(97)).cast("bigint")).where("batch = 2").limit(500)
    missing = details.limit(300).withColumn("driver_id", F.lit(None).cast("bigint")).unionByName(details.limit(50).withColumn("dt", F.lit(None).cast("date")))
    orders, details = orders.unionByName(odd), details.unionByName(met.select(details.columns)).unionByName(missing)
    out = order_features.build(orders, given.order_ext_days, details)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(coalesce(dt") <= 2  # both sides of the narrow join by driver; all other joins share one dealing
    last = order_features.last_driver_rows(details)
    want = joins.left_nullsafe(orders.join(details.select("dt", "service_order_id").distinct(), ["dt", "service_order_id"]).select("dt", "service_order_id", "driver_id"), last, {k: k for k in ("dt", "service_order_id", "driver_id")})
    rate = lambda df, top: sorted(map(str, df.select("dt", "service_order_id", "driver_id", top).collect()))
    best = F.when(F.col("last_add_rate") > 0, F.col("last_add_rate"))
    got = out.join(want.select("dt", "service_order_id", F.col("driver_id").alias("_d"), best.alias("_best")).distinct(), (out["dt"] == want["dt"]) & (out["service_order_id"] == want["service_order_id"]) & out["driver_id"].eqNullSafe(F.col("_d")))
    assert out.count() == want.count() == got.count()
    assert got.where("_best is not null and final_add_rate <> _best").count() == 0 and got.where("_best is not null").count() > 100


def test_cuts_leave_no_shuffle_files(spark, tmp_path):
    blocks = lambda: {f for d, _, names in os.walk(spark.sparkContext._jsc.sc().conf().get("spark.local.dir", "/tmp")) if "blockmgr" in d for f in names if f.startswith("shuffle_")}
    before = blocks()
    got = session.cut(spark.range(3000).groupBy((F.col("id") % 700).alias("k")).count())
    assert got.count() == 700 and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    kept = blocks() - before
    deadline = time.time() + 10
    while kept and time.time() < deadline:
        time.sleep(0.2)
        kept = blocks() - before
    assert sum(f.endswith(".data") for f in kept) <= 8  # of the count above only
