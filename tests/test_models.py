"""Clusters, neighbours, graphs, decompositions and learners against brute force."""

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace import session
from millrace.operators import clustering, components, decomposition, evaluate, geo, graph, models, neighbours
from millrace.operators.moments import moments
from millrace.plans import text_classify


def vectors(spark, x, extra=None):
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id bigint, v array<double>")


def brute_dbscan(x, eps, least):
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1) <= eps * eps
    core = d.sum(1) >= least
    label = np.where(core, np.arange(len(x)), len(x))
    while True:
        reach = np.where(d & core[None, :], label[None, :], len(x)).min(1)
        fresh = np.where(core, np.minimum(label, reach), label)
        if (fresh == label).all():
            break
        label = fresh
    border = np.where(d & core[None, :], label[None, :], len(x)).min(1)
    out = np.where(core, label, border)
    return np.where(out == len(x), -1, out), core


def test_dbscan_with_copies_and_a_hot_area(spark):
    rng = np.random.default_rng(3)
    x = np.vstack([rng.uniform(0, 12, (250, 2)), rng.normal(5, 0.05, (150, 2)), np.repeat([[9.0, 9.0]], 60, axis=0), rng.normal([5.55, 5.0], 0.03, (60, 2))])
    points = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "point_id bigint, x double, y double")
    got = clustering.dbscan(points, 0.5, 5).toPandas().set_index("point_id").sort_index()
    want, core = brute_dbscan(x, 0.5, 5)
    assert (got["is_core"].to_numpy() == core).all()
    # copies share one node, named by their smallest id, as brute force does
    assert (got["cluster"].to_numpy() == want).all()


@pytest.mark.parametrize("dims", [1, 3, 8])
def test_dbscan_in_more_dimensions(spark, dims):
    rng = np.random.default_rng(dims)
    x = np.vstack([rng.uniform(0, 3, (150, dims)), rng.normal(1.0, 0.08, (120, dims)), rng.normal(2.2, 0.1, (80, dims)), np.repeat(rng.uniform(0, 3, (2, dims)), 20, axis=0)])
    axes = tuple(f"p{i}" for i in range(dims))
    rows = [(i, *map(float, p)) for i, p in enumerate(x)] + [(1000, *[None] * dims)]
    points = spark.createDataFrame(rows, "point_id bigint, " + ", ".join(f"{a} double" for a in axes))
    eps = {1: 0.02, 3: 0.25, 8: 0.45}[dims]
    got = clustering.dbscan(points, eps, 5, axes).toPandas().set_index("point_id").sort_index()
    want, core = brute_dbscan(x, eps, 5)
    assert core.any() and not core.all()
    assert (got["is_core"].to_numpy()[:-1] == core).all() and (got["cluster"].to_numpy()[:-1] == want).all()
    assert got.loc[1000, "cluster"] == -1


def test_components_of_random_edges_and_a_chain(spark):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(300, 360)]
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r["v"]: r["component"] for r in components.connected_components(spark.range(361).withColumnRenamed("id", "v"), frame).collect()}
    want = {v: v for v in range(361)}
    for _ in range(361):
        for x, y in edges:
            want[x] = want[y] = min(want[x], want[y])
    assert got == want


def test_nearest_rows_is_exact_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 40)
    rng = np.random.default_rng(7)
    base = np.vstack([rng.normal(0, 1, (300, 4)), rng.normal(6, 0.2, (200, 4))])
    asked = rng.normal(1, 2, (60, 4))
    rows = spark.createDataFrame([(i, list(map(float, r))) for i, r in enumerate(base)], "row_id bigint, vector array<double>")
    queries = spark.createDataFrame([(i, list(map(float, r))) for i, r in enumerate(asked)], "query_id bigint, vector array<double>")
    got = neighbours.nearest_rows(queries, rows, 5).toPandas().sort_values(["query_id", "rank"])
    d = np.sqrt(((asked[:, None, :] - base[None, :, :]) ** 2).sum(-1))
    assert (got["row_id"].to_numpy().reshape(60, 5) == np.argsort(d, axis=1)[:, :5]).all()


def test_nearest_rows_limit_before_the_last_shuffle(spark):
    rows = spark.range(50).selectExpr("id as row_id", "array(double(id), 1.0) as vector")
    found = neighbours.nearest_rows(rows.withColumnRenamed("row_id", "query_id"), rows, 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan.split("WindowGroupLimit", 2)[-1]


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_codebook_ids_keep_their_type(spark, monkeypatch, limit):
    monkeypatch.setattr(neighbours, "CODEBOOK_NUMBERS", limit)
    points = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(10)], "p int, v array<double>")
    for ids, kind in ((["b", "a", "c"], "string"), ([7, 3, 9], "int")):
        centres = spark.createDataFrame(list(zip(ids, [[1.0, 0.0], [1.0, 0.0], [8.0, 0.0]])), f"c {kind}, w array<double>")
        found = neighbours.assign_nearest(points, "p", "v", centres, "c", "w")
        assert dict(found.dtypes)["c"] == kind
        assert {r["p"]: r["c"] for r in found.collect()} == {i: ids[1] if i < 5 else ids[2] for i in range(10)}


def test_radius_join_near_the_poles(spark):
    rng = np.random.default_rng(3)
    spots = [(89.99, 0.0), (89.99, 90.0), (-90.0, 10.0), (90.0, -170.0)] + [(float(a), float(b)) for a, b in zip(rng.choice([0.0, 60.0, 89.5, 89.98, -89.99], 150) + rng.normal(0, 0.01, 150), rng.uniform(-180, 180, 150)) if abs(a) <= 90]
    spots += [(0.0, 179.995), (0.0, -179.995), (0.004, -180.0)]
    frame = spark.createDataFrame([(i, *s) for i, s in enumerate(spots)], "point_id int, lat double, lng double")
    got = {(r["point_id"], r["place_id"]) for r in geo.pairs_within(frame, frame.withColumnRenamed("point_id", "place_id"), 3000.0).collect()}
    p, q = np.radians(np.array(spots)).T
    a = np.sin((p[:, None] - p) / 2) ** 2 + np.cos(p[:, None]) * np.cos(p) * np.sin((q[:, None] - q) / 2) ** 2
    d = 2 * geo.EARTH_KM * 1000 * np.arcsin(np.sqrt(np.minimum(a, 1)))
    assert got == set(zip(*(x.tolist() for x in np.nonzero(d <= 3000)))) and (0, 1) in got


def test_loops_leave_no_folders(spark):
    import os

    from millrace.session import scratch_root

    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(40, 0), (5, 30), (50, 1)], "src bigint, dst bigint")
    folder = scratch_root(spark).removeprefix("file:")
    for run, kept in ((lambda: graph.pagerank(edges, rounds=8, early_stop=False), 2), (lambda: components.connected_components(spark.range(60).withColumnRenamed("id", "v"), edges.toDF("a", "b")), 1)):
        before = set(os.listdir(folder))
        run().collect()
        assert len(set(os.listdir(folder)) - before) <= kept


def test_pagerank_converges_to_the_fixed_point(spark, given):
    links = given.links.select("src", "dst").distinct()
    got = graph.pagerank(links).toPandas().set_index("node")["score"]
    pairs = links.toPandas()
    out = pairs.groupby("src").size()
    new = pairs.assign(s=[got[a] / out[a] for a in pairs["src"]]).groupby("dst")["s"].sum().reindex(got.index).fillna(0)
    loose = got[[n for n in got.index if n not in out.index]].sum()
    assert np.allclose(0.85 * new + 0.85 * loose / len(got) + 0.15 * got.sum() / len(got), got, atol=1e-8)


def test_redirects_with_cycles_and_self_loops(spark):
    table = {1: 2, 2: 3, 3: 4, 5: 6, 6: 5, 7: 5, 8: 7, 9: 9, 10: 9, 11: 10, 12: 13, 13: 14, 14: 12, 15: 14, 16: 15}
    want = {}
    for source in table:
        here, seen = table[source], {source}
        while True:
            stop, here = here, table.get(here)
            if here is None or here in seen:
                break
            seen.add(here)
        want[source] = stop
    frame = spark.createDataFrame(list(table.items()), "src bigint, dst bigint")
    assert {r["src"]: r["target"] for r in graph.resolve_redirects(frame).collect()} == want


def test_pagerank_converges_and_sums_to_one(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 1), (4, 1), (2, 5)], "src bigint, dst bigint")
    scores = {r["node"]: r["score"] for r in graph.pagerank(edges).collect()}
    assert sum(scores.values()) == pytest.approx(1.0)
    assert scores[4] == min(scores.values())


def test_radius_join_over_the_date_line(spark):
    points = spark.createDataFrame([(1, 0.0, 179.999), (2, 50.0, 10.0), (3, -60.0, -180.0)], "point_id bigint, lat double, lng double")
    places = spark.createDataFrame([(7, 0.0, -179.999), (8, 50.001, 10.0), (9, -60.0, 179.9999)], "place_id bigint, lat double, lng double")
    got = {(r["point_id"], r["place_id"]) for r in geo.radius_join(points, places, 500.0).collect()}
    assert got == {(1, 7), (2, 8), (3, 9)}
    assert {(r["point_id"], r["place_id"]) for r in geo.radius_join(points, places, 50.0).collect()} == {(1, None), (2, None), (3, 9)}


def test_components_agree_for_whole_and_merged_rows(spark):
    x = np.random.default_rng(2).normal(0, [3, 2, 1, 0.5], (400, 4))
    df = vectors(spark, x)
    _, directions, variances = decomposition.pca(df, "v", 2, "pc")
    merged_directions, merged = decomposition.incremental_pca(df, "id", "v", 2)
    assert merged == pytest.approx(variances) and merged_directions == pytest.approx(directions)
    assert moments(df.repartition(8), "v").covariance() == pytest.approx(np.cov(x.T))


def test_sparse_svd_matches_numpy(spark):
    rng = np.random.default_rng(4)
    a = rng.random((40, 25)) * (rng.random((40, 25)) < 0.4) + np.outer(rng.random(40), rng.random(25)) * 4
    entries = spark.createDataFrame([(i, j, float(a[i, j])) for i in range(40) for j in range(25) if a[i, j]], "row bigint, col bigint, v double")
    u, sigma, v = decomposition.subspace_svd(entries, 2, iterations=8)
    assert sigma == pytest.approx(np.linalg.svd(a)[1][:2], rel=1e-4)
    left = np.array([r["vec"] for r in u.orderBy("row").collect()])
    assert np.abs(left.T @ left - np.eye(2)).max() < 1e-8


@pytest.mark.parametrize("size", [1 << 19, 60, 15])
def test_products_shuffle_a_row_per_block_and_column(spark, monkeypatch, size):
    monkeypatch.setattr(decomposition, "BLOCK_ENTRIES", size)
    rng = np.random.default_rng(5)
    a = rng.random((30, 20)) * (rng.random((30, 20)) < 0.5)
    a[7] = rng.random(20)  # stays in long form where blocks hold 15 entries
    entries = spark.createDataFrame([(str(i), f"t{j}", float(a[i, j])) for i in range(30) for j in range(20) if a[i, j]] + [(None, "t3", 9.0)], "row string, col string, v double")
    right = spark.createDataFrame([(f"t{j}", [1.0, float(j)]) for j in range(20)], "col string, vec array<double>")
    factors = np.stack([np.ones(20), np.arange(20.0)], axis=1)
    scaled = np.divide(a, np.sqrt(np.outer(a.sum(axis=1), a.sum(axis=0))), where=a > 0, out=np.zeros_like(a))
    matrix = decomposition.RowBlocks(entries)
    got = {r["row"]: r["vec"] for r in matrix.times(right, 2).collect()}
    assert np.allclose([got[str(i)] for i in range(30)], a @ factors) and got[None] == [9.0, 27.0]
    found = matrix.there_and_back(right, 2).collect()
    assert np.allclose([dict(found)[f"t{j}"] for j in range(20)], a.T @ a @ factors) and len(found) == 20
    assert matrix._pass(right, 2, True, False).count() <= 20 * matrix.blocks.count()
    matrix.close()
    matrix = decomposition.RowBlocks(entries.where("row is not null"), normalised=True)
    found = dict(matrix.there_and_back(right, 2, normalised=True).collect())
    assert np.allclose([found[f"t{j}"] for j in range(20)], scaled.T @ scaled @ factors)
    matrix.close()


def test_nmf_loss_never_rises(spark):
    rng = np.random.default_rng(6)
    a = rng.random((20, 3)) @ rng.random((3, 12))
    entries = spark.createDataFrame([(i, j, float(a[i, j])) for i in range(20) for j in range(12)], "row bigint, col bigint, v double")
    _, _, losses = decomposition.nmf(entries, 3, iterations=5)
    assert all(b <= a * (1 + 1e-9) for a, b in zip(losses, losses[1:])) and losses[-1] < losses[0]


def test_independent_components_are_found(spark):
    rng = np.random.default_rng(8)
    s = np.stack([np.sign(rng.normal(size=1500)) * rng.random(1500), rng.laplace(size=1500)], axis=1)
    out, _ = decomposition.fast_ica(vectors(spark, s @ np.array([[1.0, 0.6], [0.4, 1.0]]).T), "v", 2, iterations=30)
    found = np.array([r["sources"] for r in out.orderBy("id").collect()])
    match = np.abs(np.corrcoef(found.T, s.T)[:2, 2:])
    assert match.max(axis=1).min() > 0.95


def test_outlier_shares_follow_contamination(spark):
    rng = np.random.default_rng(9)
    angle, radius = rng.uniform(0, 2 * np.pi, 20), rng.uniform(6, 10, 20)
    x = np.vstack([rng.normal(0, 1, (380, 2)), np.stack([radius * np.cos(angle), radius * np.sin(angle)], axis=1)])  # scattered, not a clump
    df = vectors(spark, x)
    for flagged in (clustering.isolation_forest(df, "id", "v", trees=30, contamination=0.05), clustering.elliptic_envelope(df, "id", "v", 0.05)):
        strange = {r["id"] for r in flagged.where("outlier").collect()}
        assert len(strange) == 20 and len(strange & set(range(380, 400))) >= 18
    model = clustering.one_class_fit(df, "v", 2, nu=0.1)
    assert clustering.one_class_score(df, "v", model).where("novel").count() == pytest.approx(40, abs=2)


def test_learners_beat_the_majority(spark):
    rng = np.random.default_rng(10)
    x = rng.normal(0, 1, (600, 3))
    y = (x @ np.array([1.0, -2.0, 0.5]) + 0.3 > 0).astype(int)
    df = spark.createDataFrame([(i, list(map(float, r)), int(c)) for i, (r, c) in enumerate(zip(x, y))], "id bigint, v array<double>, y int")
    fits = [models.averaged_learner(df, "v", "y", k, passes=20) for k in ("hinge", "perceptron", "passive_aggressive")] + [models.ridge_classifier(df, "v", "y")]
    for w in fits:
        assert df.agg(F.avg((models.linear_prediction("v", w) == F.col("y")).cast("double"))).first()[0] > 0.9
    from millrace.operators.features import to_vector

    data = to_vector(df, "v").select("id", "features", F.col("y").cast("double").alias("label"))
    boosted = models.boosted_prediction(data, models.adaboost(data, 8))
    assert boosted.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0] > 0.8


def test_cluster_scores_of_equal_labels(spark):
    df = spark.createDataFrame(pd.DataFrame({"a": np.arange(300) % 3, "b": (np.arange(300) % 3 + 1) % 3, "c": np.arange(300) // 100}))
    same, other = evaluate.cluster_scores(df, "a", "b").first(), evaluate.cluster_scores(df, "a", "c").first()
    assert list(same) == pytest.approx([1.0] * 5)
    assert other["ari"] < 0.01 and other["ami"] < 0.01


def test_sampled_silhouette_is_bounded(spark, given):
    value = evaluate.silhouette_sample(given.embeddings, "vec_id", "embedding", "label", size=100)
    assert -1 <= value <= 1


def test_text_models_use_every_term(spark):
    # 700 rare words, each in two training and one test document of one class, beside words common to both
    rows = [(f"common words here w{k}rare", k % 2, part) for k in range(700) for part in ("train", "train", "test")]
    docs = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "doc_id bigint, text string, label int, part string")
    train, test = docs.where("part = 'train'"), docs.where("part = 'test'")
    got = {r["model"]: r for r in text_classify.run(train, test).collect()}
    assert len(got) == 14 and all(r["n_test"] == 700 for r in got.values())
    for name in ("svc l2", "sgd l2", "ridge", "multinomial bayes", "bernoulli bayes", "passive aggressive", "perceptron", "nearest centroid"):
        assert got[name]["accuracy"] > 0.99, name


def test_a_decomposition_leaves_only_its_result(spark):
    """Blocks, entries and rounds of a finished decomposition are deleted, with the cuts that the caller calls spent."""
    folder = lambda: set(os.listdir(session.scratch_root(spark).removeprefix("file:")))
    rng = np.random.default_rng(6)
    rows = [(int(r), f"c{c}", float(rng.integers(1, 5))) for r in range(40) for c in rng.choice(15, 6, False)]
    entries = spark.createDataFrame(rows, "row bigint, col string, v double")
    before, given = folder(), session.cut(entries)
    placed, kept = decomposition.truncated_svd(given, 2, spent=True)
    assert len(folder() - before) == 1 and placed.count() == 40 and 0 < kept <= 1
    again, same = decomposition.truncated_svd(entries, 2)
    assert same == pytest.approx(kept)
    before = folder()
    found = decomposition.cocluster(session.cut(entries.withColumn("row", F.col("row").cast("string"))), 2, spent=True)
    assert len(folder() - before) == 2 and found.agg(F.sum("n_rows"), F.sum("n_cols")).first()[:] == (40, 15)
