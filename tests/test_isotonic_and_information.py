"""Distributed isotonic fits and range-summed information against one-machine computation."""

import math

import numpy as np
import pandas as pd
import pytest

from millrace.operators import evaluate, isotonic


def one_machine(x, y):
    frame = pd.DataFrame({"x": x, "y": y}).groupby("x")["y"].agg(["sum", "count"]).reset_index()
    low, weight, total = isotonic.pool(*(frame[c].to_numpy(float) for c in ("x", "count", "sum")))
    return frame["x"].to_numpy(), (total / weight)[np.searchsorted(low, frame["x"], "right") - 1]


@pytest.mark.parametrize("kind", ["noisy", "falling", "rising", "ties", "step"])
def test_isotonic(spark, kind):
    rng = np.random.default_rng(1)
    x = rng.random(20_000)
    y = {"noisy": x + rng.normal(0, 0.5, len(x)), "falling": -x, "rising": x, "ties": rng.normal(0, 1, len(x)), "step": (x < 0.02) * 50.0}[kind]
    if kind == "ties":
        x = np.round(x, 2)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y})).repartition(5)
    got = isotonic.isotonic_fit(df, "x", "y").toPandas().sort_values("boundary")
    at, fitted = one_machine(x, y)
    assert np.array_equal(got["boundary"], at) and np.allclose(got["fitted"], fitted)
    down = isotonic.isotonic_fit(df, "x", "y", rising=False).toPandas().sort_values("boundary")
    assert np.allclose(down["fitted"], -one_machine(x, -y)[1])


def test_isotonic_of_few_rows(spark):
    df = spark.createDataFrame([(3.0, 1.0), (1.0, 2.0), (2.0, None), (None, 5.0), (4.0, 9.0)], "x double, y double")
    assert sorted(tuple(r) for r in isotonic.isotonic_fit(df, "x", "y").collect()) == [(1.0, 1.5), (3.0, 1.5), (4.0, 9.0)]
    assert isotonic.isotonic_fit(df.limit(0), "x", "y").collect() == []


def test_single_blocks_meet(spark, monkeypatch):
    """Ranges that pool to one block each still merge."""
    df = spark.createDataFrame([(float(i), float(-(i // 10))) for i in range(400)], "x double, y double").repartition(40)
    got = isotonic.isotonic_fit(df, "x", "y").toPandas()
    assert len(got) == 400 and np.allclose(got["fitted"], -19.5)


@pytest.mark.parametrize("terms", [3, 65_536])
def test_expected_information(spark, monkeypatch, terms):
    monkeypatch.setattr(evaluate, "TERMS", terms)
    a, b = [4, 4, 9, 20], [1, 6, 30]
    n, g = sum(a), math.lgamma
    want = sum(k / n * math.log(n * k / (x * y)) * math.exp(g(x + 1) + g(y + 1) + g(n - x + 1) + g(n - y + 1) - g(n + 1) - g(k + 1) - g(x - k + 1) - g(y - k + 1) - g(n - x - y + k + 1))
               for x in a for y in b for k in range(max(1, x + y - n), min(x, y) + 1))
    sizes = lambda v, c, m: spark.createDataFrame(list(pd.Series(v).value_counts().items()), f"{c} bigint, {m} bigint")
    assert evaluate.expected_information(sizes(a, "a", "ma"), sizes(b, "b", "mb"), n) == pytest.approx(want)


def test_ranges_that_underflow_are_nothing():
    n, a, b = 10**7, 3 * 10**6, 4 * 10**6
    whole = sum(evaluate._information_of_range(a, b, n, low) for low in range(1, a + 1, evaluate.TERMS))
    assert 0 < whole < 1e-6 and evaluate._information_of_range(a, b, n, 1) == 0.0
