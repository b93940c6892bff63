"""Cross-validation, searches over parameters, learning curves and sweeps."""

from __future__ import annotations

import math
import random

from pyspark.ml import Estimator
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.sampling import folds, unit_number
from millrace.session import cut, drop_cut

# Rows that one task of a fit takes at least.
TASK_ROWS = 2_500


def cross_val_scores(df: DataFrame, key: str, estimator: Estimator, evaluator: Evaluator, k: int, label: str | None = None) -> DataFrame:
    """Score on each held-out fold."""
    data = folds(df, key, k, label).cache()
    scores = [(i, float(evaluator.evaluate(estimator.fit(data.where(F.col("fold") != i)).transform(data.where(F.col("fold") == i))))) for i in range(k)]
    data.unpersist()
    return df.sparkSession.createDataFrame(scores, "fold int, score double")


def search(df: DataFrame, key: str, estimator: Estimator, candidates: list[dict], evaluator: Evaluator, k: int, parallelism: int = 4):
    """Cross-validate every candidate on the same stable folds.

    Returns (table of candidate, mean, std, rank; best fitted model). A fit runs tens of small
    jobs, so its rows lie in as many partitions as they fill, whatever the shuffle width.
    """
    placed = cut(folds(df, key, k))
    data = placed.coalesce(max(1, math.ceil(placed.count() / TASK_ROWS))).cache()
    model = CrossValidator(estimator=estimator, estimatorParamMaps=candidates, evaluator=evaluator, numFolds=k, foldCol="fold", parallelism=parallelism).fit(data)
    data.unpersist()
    drop_cut(placed)
    sign = 1 if evaluator.isLargerBetter() else -1
    order = sorted(range(len(candidates)), key=lambda i: -sign * model.avgMetrics[i])
    name = lambda m: ", ".join(sorted(f"{p.name}={_short(v)}" for p, v in m.items()))
    rows = [(i, name(candidates[i]), float(model.avgMetrics[i]), float(model.stdMetrics[i]), order.index(i) + 1) for i in range(len(candidates))]
    table = df.sparkSession.createDataFrame(rows, "candidate int, params string, mean_score double, std_score double, rank int")
    return table.orderBy("rank"), model.bestModel


def _short(value) -> str:
    if isinstance(value, list):
        return "+".join(type(v).__name__ for v in value)
    return str(value)


def draw_candidates(choices: dict, n: int, seed: int = 0) -> list[dict]:
    """n parameter maps; each value is a list to choose from or an (inclusive) integer range."""
    rng = random.Random(seed)
    pick = lambda c: rng.randint(*c) if isinstance(c, tuple) else rng.choice(c)
    return [{p: pick(c) for p, c in choices.items()} for _ in range(n)]


def learning_curve(df: DataFrame, key: str, estimator: Estimator, evaluator: Evaluator, shares: list[float], k: int) -> DataFrame:
    """Training and test score for growing shares of the training rows, averaged over folds.
    Shares are nested: a larger one contains the smaller ones."""
    data = folds(df, key, k).withColumn("_u", unit_number(F.lit(1), F.col(key))).cache()
    out = []
    for share in shares:
        for i in range(k):
            train = data.where((F.col("fold") != i) & (F.col("_u") < share))
            model = estimator.fit(train)
            out.append((share, i, float(evaluator.evaluate(model.transform(train))), float(evaluator.evaluate(model.transform(data.where(F.col("fold") == i))))))
    data.unpersist()
    scores = df.sparkSession.createDataFrame(out, "share double, fold int, train double, test double")
    return scores.groupBy("share").agg(*[f(c).alias(f"{c}_{n}") for c in ("train", "test") for n, f in (("mean", F.avg), ("std", F.stddev_pop))])


def sweep(df: DataFrame, key: str, fits: dict, evaluator: Evaluator, complexity, train_share: float = 0.7) -> DataFrame:
    """Held-out score and model complexity for each (name, value, estimator)."""
    data = df.withColumn("_t", unit_number(F.lit(2), F.col(key)) < train_share).cache()
    train, test = data.where("_t"), data.where("not _t")
    out = []
    for (name, value), estimator in fits.items():
        model = estimator.fit(train)
        out.append((name, float(value), float(evaluator.evaluate(model.transform(test))), float(complexity(model))))
    data.unpersist()
    return df.sparkSession.createDataFrame(out, "parameter string, value double, score double, complexity double")
