"""K-means from many starts and the robust envelope, against direct computation."""

import numpy as np
import pandas as pd
import pytest
from conftest import SF_DIR

from millrace import catalog
from millrace.operators import clustering, kmeans_runs, robust

catalog.load_all()


def frame(spark, x):
    return spark.createDataFrame(pd.DataFrame({"id": np.arange(len(x)), "v": list(x)})).repartition(4)


def test_best_run_is_never_above_the_first_rows(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 8, (8, 3))
    x = centres[np.sort(rng.integers(0, 8, 500))] + rng.normal(0, 0.3, (500, 3))  # sorted, so first rows are a bad start
    runs = kmeans_runs.fit_runs(frame(spark, x), "id", "v", 8, runs=4)
    assert [r.start for r in runs].count("k-means||") == 4 and len(runs) == 10
    first = next(r for r in runs if r.start == "first rows")
    assert runs[0].inertia <= first.inertia and runs[0].inertia < 0.5 * first.inertia
    for r in runs:
        assert r.inertia == pytest.approx(((x[:, None] - r.centres) ** 2).sum(-1).min(axis=1).sum())
    means = np.stack([x[((x[:, None] - runs[0].centres) ** 2).sum(-1).argmin(axis=1) == k].mean(axis=0) for k in range(8)])
    assert np.allclose(means, runs[0].centres, atol=1e-3)


def test_runs_on_few_points(spark):
    runs = kmeans_runs.fit_runs(frame(spark, np.repeat([[1.0, 2.0], [3.0, 4.0]], 5, axis=0)), "id", "v", 3, runs=2)
    assert runs[0].inertia == pytest.approx(0, abs=1e-12) and all(r.centres.shape == (3, 2) for r in runs)


def test_planted_outliers_are_found(spark):
    rng = np.random.default_rng(2)
    x = np.vstack([rng.multivariate_normal([5, -3], [[2.0, 1.2], [1.2, 1.5]], 350), rng.normal([16, 14], 0.7, (150, 2))])
    planted = np.arange(500) >= 350
    got = robust.robust_envelope(frame(spark, x), "id", "v", 0.3).toPandas().sort_values("id")
    assert (got["outlier"].to_numpy() == planted).mean() > 0.99
    plain = clustering.elliptic_envelope(frame(spark, x), "id", "v", 0.3).toPandas().sort_values("id")
    assert (plain["outlier"].to_numpy() == planted).mean() < 0.9
    mean, cov = robust.minimum_covariance(frame(spark, x), "id")
    assert np.allclose(mean, [5, -3], atol=0.3) and np.allclose(cov, [[2.0, 1.2], [1.2, 1.5]], atol=0.5)


def test_a_concentration_step_is_bounded_by_the_exact_rank(spark, monkeypatch):
    monkeypatch.setattr(robust, "BLOCK_VALUES", 500)
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(0, 3, (2000, 2)), 3)
    x[::7], x[5] = x[0], [np.nan, 1.0]
    blocks = robust._packed(frame(spark, x))
    assert blocks.count() > 2
    distances = lambda v: np.stack([v[:, 0], -v[:, 1] ** 3, v[:, 0] * 0 + 7], axis=1)
    for rank in (1, 700, 1001, 1999):
        expected = [np.sort(d)[rank - 1] for d in distances(x).T]  # what is not a number comes last
        assert robust._ranked(blocks, distances, 2, 3, rank, 0.0).tolist() == expected
        near = robust._ranked(blocks, distances, 2, 3, rank, 20.0)
        assert all(rank - 1 <= np.searchsorted(np.sort(d), v, "right") <= rank + max(20, (d == v).sum()) for d, v in zip(distances(x).T, near))


def test_quantiles_of_chi_square():
    assert robust.chi2_quantile(0.5, 2) == pytest.approx(2 * np.log(2)) and robust.chi2_quantile(0.975, 1) == pytest.approx(5.02389, abs=1e-4)


def test_registered_queries(spark):
    runs = catalog.QUERIES["kmeans_runs"](spark, SF_DIR).toPandas().sort_values("rank")
    assert len(runs) == 22 and runs["inertia"].is_monotonic_increasing
    found = catalog.QUERIES["robust_envelope"](spark, SF_DIR).toPandas()
    assert found["id"].is_unique and 0 < found["outlier"].mean() <= 0.1
