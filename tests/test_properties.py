"""Every registered query without SQL, run as registered and held against a property of its result.

Queries that learn from vectors run on a copy of the data whose vectors carry their label, so
a learner that works has to find it again on rows it has not seen.
"""

import os
import re

import numpy as np
import pandas as pd
import pytest
from conftest import SF_DIR

from millrace import catalog

catalog.load_all()


@pytest.fixture(scope="module")
def planted(tmp_path_factory):
    folder = tmp_path_factory.mktemp("planted")
    for name in os.listdir(SF_DIR):
        if name != "embeddings.parquet":
            os.symlink(os.path.join(SF_DIR, name), folder / name)
    rows = pd.read_parquet(os.path.join(SF_DIR, "embeddings.parquet"))
    noise = np.random.default_rng(1).normal(0, 0.1, (len(rows), len(rows["embedding"].iloc[0])))
    noise[np.arange(len(rows)), rows["label"].to_numpy() % 10] += 1.0
    rows["embedding"] = list(noise.astype(np.float32))
    rows.to_parquet(folder / "embeddings.parquet")
    return str(folder)


def run(spark, name, folder=SF_DIR):
    return catalog.QUERIES[name](spark, folder).toPandas()


def vectors(folder=SF_DIR):
    rows = pd.read_parquet(os.path.join(folder, "embeddings.parquet")).sort_values("vec_id")
    return rows["vec_id"].to_numpy(), np.stack(rows["embedding"].to_numpy()).astype(float), rows["label"].to_numpy()


@pytest.mark.parametrize("name, least", [("decision_tree", 0.4), ("random_forest", 0.6), ("one_vs_rest", 0.8), ("neural_net", 0.7), ("adaboost", 0.7), ("l1_svc_select", 0.8), ("lda_discriminant", 0.8)])
def test_classifiers_find_the_planted_label(spark, planted, name, least):
    got = run(spark, name, planted)
    majority = got["label"].value_counts(normalize=True).iloc[0]
    assert (got["label"] == got["prediction"]).mean() > max(least, majority) and got["vec_id"].is_unique


def test_support_vectors_find_the_planted_label(spark, planted):
    got = run(spark, "linear_svc", planted)
    assert (got["label"] == got["plain"]).mean() > 0.8
    rare = got["label"].value_counts().idxmin()
    assert (got["weighted"] == rare).sum() >= (got["plain"] == rare).sum()


def test_logistic_penalties(spark, planted):
    got = run(spark, "logistic", planted).sort_values(["penalty", "c"])
    l1, l2 = got[got["penalty"] == "l1"], got[got["penalty"] == "l2"]
    assert (np.diff(l1["zero_share"]) <= 0).all() and (l2["zero_share"] <= l1["zero_share"].to_numpy()).all()
    assert got["accuracy"].max() > 0.8


def test_sgd_classifiers_learn(spark, planted):
    got = run(spark, "sgd_classifiers", planted)
    assert (got["accuracy"] > 0.75).all() and got["model"].is_unique


def test_searches_rank_their_candidates(spark, planted):
    for name in ("grid_search", "random_search"):
        got = run(spark, name, planted).sort_values("rank")
        assert (np.diff(got["mean_score"]) <= 0).all() and got["candidate"].is_unique and got["mean_score"].iloc[0] > 0.3


def test_curves(spark, planted):
    got = run(spark, "learning_curve", planted).sort_values("share")
    assert (got["train_mean"] >= got["test_mean"] - 0.05).all() and got["test_mean"].iloc[-1] > 0.8 > got["test_mean"].iloc[0] - 0.3
    sweep = run(spark, "validation_sweep", planted)
    assert all((np.diff(g.sort_values("value")["complexity"]) <= 0).all() for _, g in sweep[sweep["parameter"] == "l1_ratio"].groupby("parameter"))


def test_folds_and_selection(spark):
    folds = run(spark, "cross_val_score")
    assert sorted(folds["fold"]) == list(range(-1, 5)) and np.isfinite(folds["score"]).all()
    steps = run(spark, "rfe_cv").sort_values("n_features")
    assert steps["n_features"].tolist() == [1, 2, 3, 4, 5] and steps["accuracy"].between(0.5, 1).all() and steps["dropped_next"].dropna().is_unique
    assert len(run(spark, "lasso_select")) == 1
    ranked = run(spark, "tree_rank")
    assert ranked["importance"].sum() == pytest.approx(1) and (ranked["importance"] >= 0).all()
    spread = run(spark, "forest_importance_spread")
    assert spread["importance"].sum() == pytest.approx(1, abs=0.02) and (spread["spread"] >= 0).all()


def test_regressions(spark):
    got = run(spark, "ridge").set_index("name")
    assert np.isfinite(got.to_numpy(dtype=float)).all() and len(got) == 4
    curve = run(spark, "isotonic").sort_values("boundary")
    assert (np.diff(curve["fitted"]) >= -1e-9).all() or (np.diff(curve["fitted"]) <= 1e-9).all()
    losses = run(spark, "boosted_regression").sort_values("trees")
    assert losses["trees"].tolist() == list(range(1, len(losses) + 1)) and (losses["loss"] > 0).all()
    assert (run(spark, "forest_regression")["r2"] <= 1).all()


def test_components_carry_the_variance(spark):
    ids, x, _ = vectors()
    values = np.linalg.eigvalsh(np.cov(x.T))[::-1]
    got = run(spark, "pca").sort_values("vec_id")
    assert got["pc1"].var() == pytest.approx(values[0], rel=1e-3) and got["pc2"].var() == pytest.approx(values[1], rel=1e-3)
    merged = run(spark, "incremental_pca")
    assert np.allclose(merged["variance"], values[: len(merged)], rtol=1e-3) and (merged["gap"].abs() < 1e-8).all()
    factors = run(spark, "factor_analysis").sort_values("pos")
    explained = (factors.filter(like="factor") ** 2).sum(axis=1) + factors["noise"]
    assert (factors["noise"] > 0).all() and np.allclose(explained, x.var(axis=0), rtol=0.1)
    sources = np.stack(run(spark, "fast_ica")["sources"].to_numpy())
    assert np.allclose(np.corrcoef(sources.T), np.eye(sources.shape[1]), atol=0.05)


def test_term_decompositions(spark):
    found = run(spark, "truncated_svd")
    assert found["explained"].between(0, 1).all() and found["explained"].nunique() == 1 and found["doc_id"].is_unique
    parts = run(spark, "nmf")
    assert (parts["weight"] >= 0).all() and (parts["loss"] > 0).all() and parts.groupby("topic").size().nunique() == 1
    nodes = run(spark, "randomized_svd")
    assert (nodes["strength"] > 0).all() and set(nodes["side"]) == {"in", "out"}
    for name, of in (("lda_topics", "topic"), ("cluster_terms", "cluster")):
        got = run(spark, name).sort_values([of, "rank"])
        assert all((np.diff(g["weight"]) <= 1e-12).all() and g["term"].is_unique for _, g in got.groupby(of))
    groups = run(spark, "cocluster")
    assert groups["cut_ratio"].dropna().between(0, 1).all() and (groups["n_rows"] >= 0).all() and groups["cut_ratio"].notna().any()


def test_outliers(spark):
    for name, flag in (("isolation_forest", "outlier"), ("one_class_linear", "novel")):
        got = run(spark, name)
        inside, outside = got[~got[flag]]["score"], got[got[flag]]["score"]
        assert got["vec_id"].is_unique and 0 <= len(outside) < 0.6 * len(got)
        assert not len(outside) or inside.max() <= outside.min() or outside.max() <= inside.min()


def test_quantised_pixels_are_near_their_code(spark):
    got = run(spark, "vector_quantise")
    assert got["error"].mean() < 0.8 * got["random_error"].mean() and got["code"].between(0, 63).all()


def test_two_kmeans_are_matched(spark):
    got = run(spark, "kmeans_agreement")
    same = got[~got["differs"]].drop_duplicates(["full_cluster", "mini_cluster"])
    assert same["full_cluster"].is_unique
    centres = run(spark, "stream_minibatch_kmeans")
    assert centres["cluster"].is_unique and (centres["n"] > 0).all()


def test_random_maps(spark):
    ids, x, _ = vectors()
    far = ((x[:100, None] - x[None, :100]) ** 2).sum(-1)
    for name, column, falls in (("random_fourier", "features", True), ("nystroem", "features", True), ("sparse_projection", "projected", False)):
        z = np.stack(run(spark, name).sort_values("vec_id")[column].to_numpy())[:100]
        near = z @ z.T if falls else -((z[:, None] - z[None]) ** 2).sum(-1)
        pick = np.triu_indices(100, 1)
        assert np.corrcoef(near[pick], far[pick])[0, 1] < -0.2, name
    position = np.stack(run(spark, "tree_embedding")["position"].to_numpy())
    assert np.isfinite(position).all() and (position.std(axis=0) > 0).all()


def test_hashed_counts_lose_no_word(spark):
    got = run(spark, "hash_vectors").groupby("doc_id")["n"].sum()
    docs = pd.read_parquet(os.path.join(SF_DIR, "documents.parquet")).set_index("doc_id")["text"]
    want = docs.map(lambda t: len(re.findall(r"\w{2,}", t.lower())))
    assert got.to_dict() == {i: n for i, n in want.items() if n}


def test_streams_see_every_row_once(spark):
    got = run(spark, "stream_learn")
    assert got["accuracy"].between(0, 1).all() and set(got["n_test"]) == {got["n_test"].iloc[0]}
    last = got[got["batch_id"] == got["batch_id"].max()]
    assert last["model"].is_unique and set(last["model"]) == set(got["model"])


def test_text_models_beat_the_majority(spark):
    got = run(spark, "text_classify")
    assert got["model"].is_unique and got["accuracy"].between(0, 1).all() and got["n_test"].nunique() == 1
    labels = pd.read_parquet(os.path.join(SF_DIR, "labels.parquet"))["quality"]
    assert got["accuracy"].max() >= labels.value_counts(normalize=True).iloc[0] - 0.05


def test_converged_scores_are_a_fixed_point(spark):
    got = run(spark, "pagerank_converged").set_index("node")["score"]
    links = catalog.Inputs(spark, SF_DIR).links.select("src", "dst").distinct().toPandas()
    out = links.groupby("src").size()
    new = links.assign(s=got[links["src"]].to_numpy() / out[links["src"]].to_numpy()).groupby("dst")["s"].sum().reindex(got.index).fillna(0)
    loose = got[~got.index.isin(out.index)].sum()
    assert np.abs(0.85 * new + (0.85 * loose + 0.15 * got.sum()) / len(got) - got).max() < len(got) * 1e-10 * got.max()


def test_species_scores(spark):
    got = run(spark, "species_model")
    assert got["species"].is_unique and got["auc"].dropna().between(0, 1).all()


def test_text_candidates_are_all_ranked(spark):
    got = run(spark, "grid_search_text")
    assert len(got) == 24 and got["params"].is_unique and got["mean_score"].between(0, 1).all()
    assert (np.diff(got.sort_values("rank")["mean_score"]) <= 0).all() and set(got["rank"]) == set(range(1, 25))


def test_runs_are_ranked_by_inertia(spark):
    got = run(spark, "kmeans_runs").sort_values("rank")
    assert (np.diff(got["inertia"]) >= 0).all() and (got["inertia"] > 0).all() and (got["steps"] > 0).all()


def test_robust_envelope_flags_the_farthest(spark):
    got = run(spark, "robust_envelope")
    assert got["id"].is_unique and abs(got["outlier"].mean() - 0.1) < 0.02
    assert got[got["outlier"]]["distance2"].min() > got[~got["outlier"]]["distance2"].max()


def test_no_query_is_left_out():
    with open(__file__) as source:
        named = set(re.findall(r'"(\w+)"', source.read()))
    assert set(catalog.QUERIES) - set(catalog.CHECKS) <= named
