"""Supervised models that are closed-form, distance-based, or a short loop of aggregations."""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.clustering import mahalanobis2
from millrace.operators.features import as_doubles, dot, literal_vector
from millrace.operators.moments import grouped_moments, moments, partition_sum
from millrace.operators.neighbours import assign_nearest, nearest_rows
from millrace.session import bounded_collect, cut


# --- least squares -----------------------------------------------------------

def least_squares(df: DataFrame, columns: list[str], target: str, alpha: float = 0.0) -> dict:
    """Coefficients, intercept, MSE and R2 of (ridge) least squares, from one pass of moments."""
    m = moments(df.select(F.array(*[F.col(c).cast("double") for c in [*columns, target]]).alias("v")), "v")
    scatter = m.scatter()
    gram, cross, spread = scatter[:-1, :-1], scatter[:-1, -1], scatter[-1, -1]
    weights = np.linalg.solve(gram + alpha * np.eye(len(gram)), cross)
    residual = spread - 2 * weights @ cross + weights @ gram @ weights
    return {"coefficients": weights, "intercept": float(m.mean[-1] - weights @ m.mean[:-1]), "mse": float(residual / m.n), "r2": float(1 - residual / spread)}


# --- naive Bayes on term counts ----------------------------------------------

def multinomial_bayes(counts: DataFrame, labels: DataFrame, key: str, alpha: float = 1.0) -> DataFrame:
    """Fit on labelled counts (key, term, n) and score the same documents:
    (key, prediction, score). No vocabulary limit; terms stay rows.

    A class's score is what its smoothing alone would give, plus a correction for the terms
    it has seen, so absent (term, class) pairs need no rows.
    """
    joined = counts.join(labels.select(key, "label"), key)
    per_class = cut(joined.groupBy("term", "label").agg(F.sum("n").alias("nc")))
    vocabulary = per_class.select("term").distinct().count()
    sizes = {r["label"]: r["s"] for r in bounded_collect(per_class.groupBy("label").agg(F.sum("nc").alias("s")), 1000, "classes")}
    priors = {r["label"]: r["n"] for r in labels.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = sum(priors.values())
    classes = F.array(*[
        F.struct(F.lit(c).alias("label"), F.lit(float(np.log(p / total))).alias("prior"), F.lit(float(np.log(alpha / (sizes.get(c, 0) + alpha * vocabulary)))).alias("floor"))
        for c, p in sorted(priors.items())])
    lengths = counts.groupBy(key).agg(F.sum("n").alias("len")).select(key, "len", F.explode(classes).alias("c")).select(
        F.col(key).alias("_k"), "c.label", (F.col("c.prior") + F.col("len") * F.col("c.floor")).alias("base"))
    gains = counts.join(per_class, "term").groupBy(F.col(key).alias("_g"), F.col("label").alias("_l")).agg(
        F.sum(F.col("n") * F.log((F.col("nc") + alpha) / alpha)).alias("gain"))
    scored = lengths.join(gains, (F.col("_k") == F.col("_g")) & (F.col("label") == F.col("_l")), "left")
    score = F.col("base") + F.coalesce("gain", F.lit(0.0))
    best = scored.groupBy("_k").agg(F.min(F.struct((-score).alias("s"), F.col("label"))).alias("b"))
    return best.select(F.col("_k").alias(key), F.col("b.label").alias("prediction"), (-F.col("b.s")).alias("score"))


# --- distances ---------------------------------------------------------------

def knn(train: DataFrame, test: DataFrame, key: str, vector: str, label: str, k: int, weights: str = "uniform") -> DataFrame:
    """(key, prediction) by vote of the k nearest training rows; the smaller label wins a tie."""
    found = nearest_rows(test.select(F.col(key).alias("query_id"), F.col(vector).alias("vector")),
                         train.select(F.col(key).alias("row_id"), F.col(vector).alias("vector")), k)
    named = found.join(train.select(F.col(key).alias("row_id"), F.col(label).alias("label")), "row_id")
    vote = F.lit(1.0) if weights == "uniform" else 1 / F.greatest("distance", F.lit(1e-12))
    votes = named.groupBy("query_id", "label").agg(F.sum(vote).alias("v"))
    best = votes.groupBy("query_id").agg(F.min(F.struct((-F.col("v")).alias("v"), "label")).alias("b"))
    return best.select(F.col("query_id").alias(key), F.col("b.label").alias("prediction"))


def nearest_centroid(train: DataFrame, test: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    centres = train.groupBy(F.col(label).alias("prediction")).agg(Summarizer.mean(array_to_vector(as_doubles(vector))).alias("_m"))
    centres = cut(centres.select("prediction", vector_to_array("_m").alias("centre")))
    return assign_nearest(test, key, vector, centres, "prediction", "centre").select(key, "prediction")


def quadratic_discriminant(train: DataFrame, test: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(key, prediction, log_likelihood) of the most likely class Gaussian."""
    groups = grouped_moments(train, vector, label)
    total = sum(m.n for m in groups.values())
    v = as_doubles(vector)
    parts = []
    for c in sorted(groups):
        m = groups[c]
        cov = m.covariance()
        constant = float(np.log(m.n / total) - 0.5 * np.linalg.slogdet(cov)[1])
        score = F.lit(constant) - mahalanobis2(v, m.mean, np.linalg.inv(cov)) * 0.5
        parts.append(F.struct((-score).alias("s"), F.lit(c).alias("c")))
    return test.withColumn("_b", F.array_min(F.array(*parts))).select(key, F.col("_b.c").alias("prediction"), (-F.col("_b.s")).alias("log_likelihood"))


# --- linear learners as averaged updates -------------------------------------

def _signed(df: DataFrame, vector: str, label: str) -> DataFrame:
    return df.select(F.concat(as_doubles(vector), F.array(F.lit(1.0))).alias("x"), F.when(F.col(label) > 0, 1.0).otherwise(-1.0).alias("y"))


def averaged_learner(train: DataFrame, vector: str, label: str, kind: str, passes: int = 10, limit: float = 1.0) -> np.ndarray:
    """Weights (intercept last) of a two-class linear learner.

    kind "perceptron" adds y*x of wrong rows, "passive_aggressive" moves each row just over
    the margin (at most `limit`), "hinge" follows the hinge loss with a shrinking step.
    A pass sums the updates of all rows per partition, then applies their average.
    """
    rows = cut(_signed(train, vector, label))
    n = rows.count()
    w = np.zeros(len(rows.first()["x"]))
    for step in range(passes):
        def update(batch, w=w, step=step):
            x, y = np.stack(batch["x"].to_numpy()), batch["y"].to_numpy()
            margin = y * (x @ w)
            if kind == "perceptron":
                t = np.where(margin <= 0, y, 0.0)
            elif kind == "passive_aggressive":
                t = np.where(margin < 1, y * np.minimum(limit, (1 - margin) / (x * x).sum(axis=1)), 0.0)
            else:
                t = np.where(margin < 1, y / (1 + step * 0.1), 0.0)
            return t @ x

        w = w + partition_sum(rows, update, len(w)) / n
    return w


def ridge_classifier(train: DataFrame, vector: str, label: str, alpha: float = 1.0) -> np.ndarray:
    """Least squares on -1/+1 labels, closed form."""
    m = moments(_signed(train, vector, label).select(F.concat("x", F.array("y")).alias("v")), "v")
    gram, cross = m.cross[:-1, :-1], m.cross[:-1, -1]
    penalty = alpha * np.eye(len(gram))
    penalty[-1, -1] = 0.0
    return np.linalg.solve(gram + penalty, cross)


def linear_prediction(vector: str, weights: np.ndarray) -> Column:
    margin = dot(as_doubles(vector), literal_vector(weights[:-1])) + float(weights[-1])
    return F.when(margin > 0, 1).otherwise(0)


def adaboost(train: DataFrame, rounds: int = 5, depth: int = 1):
    """Boosted stumps for 0/1 labels: list of (tree model, vote). Rows are re-weighted by a
    column expression and cut once per round."""
    data = cut(train.select("features", "label").withColumn("w", F.lit(1.0)))
    out = []
    for i in range(rounds):
        tree = DecisionTreeClassifier(maxDepth=depth, weightCol="w", seed=i).fit(data)
        judged = cut(tree.transform(data).select("features", "label", "w", (F.col("prediction") != F.col("label")).alias("wrong")))
        wrong, total = judged.agg(F.sum(F.when(F.col("wrong"), F.col("w")).otherwise(0.0)), F.sum("w")).first()
        error = min(max(wrong / total, 1e-10), 1 - 1e-10)
        if error >= 0.5:
            break
        vote = float(np.log((1 - error) / error))
        out.append((tree, vote))
        scale = float(total)
        data = judged.select("features", "label", (F.when(F.col("wrong"), F.col("w") * float(np.exp(vote))).otherwise(F.col("w")) / scale).alias("w"))
    return out


def boosted_prediction(df: DataFrame, boosted: list, name: str = "prediction") -> DataFrame:
    """Sign of the summed votes."""
    scored = df.withColumn("_vote", F.lit(0.0))
    for tree, vote in boosted:
        scored = tree.transform(scored).withColumn("_vote", F.col("_vote") + F.when(F.col("prediction") > 0, vote).otherwise(-vote)).drop("prediction", "rawPrediction", "probability")
    return scored.withColumn(name, F.when(F.col("_vote") > 0, 1.0).otherwise(0.0)).drop("_vote")
