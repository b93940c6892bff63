"""What a query needs must not grow faster than its input."""

import tracemalloc

import numpy as np
import pandas as pd
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from millrace.operators import geo, neighbours, sparse, text, tuning

FITTED_ON = []


class Recorded(LinearRegression):
    def _fit(self, dataset):
        FITTED_ON.append(dataset.rdd.getNumPartitions())
        return super()._fit(dataset)


def test_search_fits_small_data_in_few_tasks(spark):
    width = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        rows = spark.range(300, numPartitions=30).select("id", (F.col("id") * 2.0).alias("label"), F.array(F.col("id").cast("double")).alias("v"))
        from pyspark.ml.functions import array_to_vector

        rows = rows.select("id", "label", array_to_vector("v").alias("features"))
        learner = Recorded()
        table, best = tuning.search(rows, "id", learner, [{learner.regParam: 0.0}, {learner.regParam: 5.0}], RegressionEvaluator(), 3, parallelism=1)
        assert [r["rank"] for r in table.collect()] == [1, 2] and best is not None
        assert len(FITTED_ON) == 7 and max(FITTED_ON) <= 2
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)


def test_queries_that_visit_every_block_leave_in_bounded_batches():
    pivots, blocks = np.random.default_rng(0).random((50, 64)), 500
    batch = pd.DataFrame({"query_id": np.arange(200), "vector": list(np.random.default_rng(1).random((200, 64)))})

    def everywhere(part, far):
        return np.nonzero(np.ones((len(part), blocks), bool))

    parts = list(neighbours._spread(everywhere, ["query_id", "vector"], pivots, blocks)([batch]))
    assert max(len(p) for p in parts) * 64 <= neighbours.BATCH_NUMBERS
    seen = pd.concat([p[["query_id", "block"]] for p in parts])
    assert len(seen) == 200 * blocks and not seen.duplicated().any()


def _counted_rows(df):
    """Largest number of output rows of a join in the plan, after running it."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            todo.append(node.executedPlan())
            continue
        if "Join" in node.nodeName() and node.metrics().contains("numOutputRows"):
            found.append(node.metrics().apply("numOutputRows").value())
        todo += [node.children().apply(i) for i in range(node.children().size())] + ([node.plan()] if "QueryStage" in node.nodeName() else [])
    return max(found, default=0)


def _globe(spark, n, name, step):
    lat, lng = 39 + F.col("id") * step % 1009 / 50000, 116 + F.col("id") * step * 7 % 997 / 50000
    return spark.range(n).select(F.col("id").alias(name), lat.alias("lat"), lng.alias("lng"))


def test_a_crowd_of_roads_is_not_measured_one_by_one(spark):
    points = _globe(spark, 300, "point_id", 37).unionByName(spark.createDataFrame([(900, 10.0, 10.0), (901, None, 1.0), (None, 39.0, 116.0), (5, 39.01, 116.01)], "point_id bigint, lat double, lng double"))
    roads = _globe(spark, 3000, "place_id", 91).withColumn("heading", (F.col("place_id") % 8).cast("int"))
    found = geo.nearest_within(points, roads, 4000.0)
    assert _counted_rows(found) <= 100 * 300  # all pairs would be 900,000
    got = {r["point_id"]: r["road_id"] for r in geo.snap_to_nearest(points, roads, 4000.0).collect()}
    far = geo.haversine(F.col("lat"), F.col("lng"), F.col("rlat"), F.col("rlng"))
    pairs = points.crossJoin(roads.select("place_id", F.col("lat").alias("rlat"), F.col("lng").alias("rlng"))).withColumn("d", far).where("d <= 4000 and point_id is not null")
    want = {r["point_id"]: r["n"]["place_id"] for r in pairs.groupBy("point_id").agg(F.min(F.struct("d", "place_id")).alias("n")).collect()}
    assert got == want | {900: None, 901: None, None: None}


def test_pairs_of_one_crowded_cube_are_shared_by_tasks(spark, monkeypatch):
    monkeypatch.setattr(geo, "TASK_PAIRS", 1000)
    points, places = (_globe(spark, 200, n, 37).select(n, (F.col("lat") / 1e3 + 39).alias("lat"), (F.col("lng") / 1e3 + 116).alias("lng")).coalesce(1) for n in ("point_id", "place_id"))
    pairs = geo.pairs_within(points, places, 50_000.0)
    shares = [r["count"] for r in pairs.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(shares) == 40_000 and max(shares) <= 8_000


def test_short_vectors_meet_a_codebook_without_a_third_axis(spark):
    rng = np.random.default_rng(2)
    data, book = rng.random((2000, 3)), rng.random((64, 3))
    tracemalloc.start()
    near = neighbours._squared_gaps(data, book)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    want = ((data[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
    assert np.array_equal(near, want) and peak < 4 * near.nbytes  # seven times with the axis
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data[:50])], "id int, v array<double>")
    got = {r["id"]: (r["b"]["id"], r["b"]["dist2"]) for r in rows.select("id", neighbours.nearest_of(F.col("v"), list(enumerate(book.tolist()))).alias("b")).collect()}
    assert got == {i: (int(want[i].argmin()), float(want[i].min())) for i in range(50)}


def test_a_short_vocabulary_is_found_without_counting_every_term(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"every {'one ' * 9}word{i} " + " ".join(f"w{j}" for j in range(i % 7 + 1))) for i in range(60)] + [(0, "every w1 w1"), (None, "w2 w2"), (61, None)], "doc_id int, text string")
    tokens = text.words(F.col("text"))
    want = text.limit_vocabulary(text.term_counts(docs, "doc_id", tokens), 63, 2, 0.9, 3)
    met, plain = [], text.term_counts
    monkeypatch.setattr(text, "term_counts", lambda *a: met.append(plain(*a).select("term").distinct().count()) or plain(*a))
    got = text.top_counts(docs, "doc_id", tokens, 63, 2, 0.9, 3)
    assert sorted(map(str, got.select("doc_id", "term", "n").collect())) == sorted(map(str, want.select("doc_id", "term", "n").collect()))
    assert met == [6]
    text.top_counts(docs, "doc_id", tokens, 63, 50, 0.1, 3).count()  # too few pass: all terms are met at last
    assert met[1:] == [6, 48, plain(docs, "doc_id", tokens).select("term").distinct().count()]


def test_a_share_of_documents_keeps_no_tokens(spark):
    docs = spark.createDataFrame([(["aa", "bb"],), (["aa"],), (["aa", "cc", "bb"],), (["cc", "dd"],)], "tokens array<string>")
    fit = lambda most: CountVectorizer(inputCol="tokens", outputCol="tf", minDF=2, maxDF=most).fit(docs).vocabulary
    assert text.largest_df(docs, 0.5) == 2.0 and text.largest_df(docs.limit(1), 0.5) == 0.5
    assert fit(text.largest_df(docs, 0.5)) == fit(0.5)


def test_pairs_of_blocks_are_not_shuffled(spark):
    rng = np.random.default_rng(3)
    entries = [("", k, int(i), float(rng.random())) for k in range(40) for i in rng.choice(30, 5, replace=False)]
    rows = spark.createDataFrame(entries, "run string, key bigint, i bigint, value double")
    labels = spark.range(40).select(F.lit("").alias("run"), F.col("id").alias("key"), (F.col("id") % 2).cast("double").alias("label"))
    packed = sparse.blocks(rows, labels, "key")
    votes = sparse.knn_votes(packed, packed, 1)
    assert {r["key"]: r["prediction"] for r in votes.collect()} == {k: float(k % 2) for k in range(40)}
    plan = votes._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("MapInPandas"):].split("Initial Plan")[0]
    assert "CartesianProduct" in below and "Exchange" not in below
