"""Exact nearest rows through metric blocks, against brute force."""

import numpy as np
import pandas as pd
import pytest

from millrace.operators import neighbours


def frame(spark, ids, vectors, name):
    return spark.createDataFrame(pd.DataFrame({name: ids, "vector": list(vectors)}))


def brute(queries, rows, k):
    out = {}
    for i, q in enumerate(queries):
        distance = np.sqrt(((rows - q) ** 2).sum(axis=1))
        out[i] = np.lexsort((np.arange(len(rows)), distance))[:k].tolist()
    return out


@pytest.mark.parametrize("kind", ["clustered", "uniform", "hot", "line"])
def test_blocks_give_the_nearest_rows(spark, monkeypatch, kind):
    monkeypatch.setattr(neighbours, "BLOCK", 60)
    rng = np.random.default_rng(1)
    if kind == "clustered":
        centres = rng.normal(0, 20, (12, 6))
        x = centres[rng.integers(0, 12, 900)] + rng.normal(0, 0.5, (900, 6))
    elif kind == "uniform":
        x = rng.random((400, 5))
    elif kind == "hot":  # a third of all rows is one point
        x = np.vstack([np.repeat([[0.5, 0.5]], 200, axis=0), rng.random((400, 2))])
    else:
        x = np.column_stack([np.arange(300.0), np.zeros(300)])
    asked = np.vstack([x[:40], x[:20] + rng.normal(0, 0.3, (20, x.shape[1]))])
    queries, rows = frame(spark, np.arange(len(asked)), asked, "query_id"), frame(spark, np.arange(len(x)), x, "row_id")
    got = neighbours.nearest_rows(queries, rows, 5).toPandas().sort_values(["query_id", "rank"])
    want = brute(asked, x, 5)
    assert {q: g["row_id"].tolist() for q, g in got.groupby("query_id")} == want
    if kind == "clustered":
        visited, blocks, n = neighbours.visits(queries, rows, 5, 60)
        assert visited.count() < n * len(asked) / 3
        assert blocks.groupBy("block").count().toPandas()["count"].max() <= 60


def test_fewer_rows_than_wanted(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 3)
    x = np.arange(8.0)[:, None]
    got = neighbours.nearest_rows(frame(spark, np.arange(2), x[:2], "query_id"), frame(spark, np.arange(8), x, "row_id"), 20).toPandas()
    assert (got.groupby("query_id")["row_id"].nunique() == 8).all()
