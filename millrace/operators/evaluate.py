"""Scores of classifiers, regressions and clusterings, from grouped counts."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.features import as_doubles, dot
from millrace.operators.ordered import running
from millrace.operators.sampling import unit_number
from millrace.session import bounded_collect, cut, drop_cut


def roc_points(scored: DataFrame, keys: list[str], score: str, positive: str) -> DataFrame:
    """Cumulated true and false positives per distinct score, highest score first.

    Rows are counted per score before anything is ordered, so ties and hot scores are one row.
    """
    counts = scored.groupBy(*keys, F.col(score).cast("double").alias("threshold")).agg(
        F.count_if(F.col(positive)).alias("pos"), F.count_if(~F.col(positive)).alias("neg"))
    return running(counts, keys, [F.desc("threshold")], {"tps": ("sum", F.col("pos"), True), "fps": ("sum", F.col("neg"), True)})


def _totals(points: DataFrame, keys: list[str]) -> DataFrame:
    area = F.col("neg") * (F.col("tps") * 2 - F.col("pos")) / 2
    return points.groupBy(*keys).agg(F.max("tps").alias("all_pos"), F.max("fps").alias("all_neg"), F.sum(area).alias("area"))


def roc_curve(scored: DataFrame, keys: list[str], score: str, positive: str) -> DataFrame:
    """(keys.., threshold, fpr, tpr, auc), trapezoid area."""
    points = cut(roc_points(scored, keys, score, positive))
    joined = points.join(_totals(points, keys), keys)
    return joined.select(*keys, "threshold", F.try_divide("fps", "all_neg").alias("fpr"), F.try_divide("tps", "all_pos").alias("tpr"),
                         F.try_divide(F.col("area"), F.col("all_pos") * F.col("all_neg")).alias("auc"))


def auc(scored: DataFrame, score: str, positive: str) -> float:
    points = roc_points(scored.withColumn("_k", F.lit(0)), ["_k"], score, positive)
    row = _totals(points, ["_k"]).first()
    return row["area"] / (row["all_pos"] * row["all_neg"])


def one_vs_rest_scores(df: DataFrame, key: str, actual: str, scores: dict) -> DataFrame:
    """One row per (row, class) with that class's score, and all of them again as `micro`."""
    parts = F.array(*[F.struct(F.lit(str(c)).alias("class"), s.cast("double").alias("score"), (F.col(actual) == F.lit(c)).alias("positive")) for c, s in scores.items()])
    long = df.select(key, F.explode(parts).alias("p")).select(key, "p.*")
    return long.withColumn("class", F.explode(F.array("class", F.lit("micro"))))


def roc_mean(scored: DataFrame, fold: str, score: str, positive: str, grid: int = 100) -> DataFrame:
    """Mean of the folds' curves at `grid` equally spaced false-positive rates.

    Each curve segment produces the grid points it covers, so curves and grid are never crossed.
    """
    points = cut(roc_points(scored, [fold], score, positive))
    totals = _totals(points, [fold]).drop("area")
    steps = points.groupBy(fold, "fps").agg(F.min("tps").alias("low"), F.max("tps").alias("high"))
    start = totals.select(fold, F.lit(0).cast("bigint").alias("fps"), F.lit(0).cast("bigint").alias("low"), F.lit(0).cast("bigint").alias("high"))
    steps = steps.unionByName(start).groupBy(fold, "fps").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    chained = running(steps, [fold], ["fps"], {"before": ("max", F.struct("fps", "high"), False)}).join(totals, fold)
    last = grid - 1
    first_at = lambda fps: F.ceil(fps * last / F.col("all_neg"))
    segment = F.when(F.col("before").isNotNull() & (first_at(F.col("before.fps")) < first_at(F.col("fps"))),
                     F.sequence(first_at(F.col("before.fps")), first_at(F.col("fps")) - 1))
    covered = chained.select("*", F.explode(segment).alias("i"))
    x = F.col("i") / last * F.col("all_neg")
    slope = (F.col("low") - F.col("before.high")) / (F.col("fps") - F.col("before.fps"))
    inner = covered.select(fold, "i", ((F.col("before.high") + slope * (x - F.col("before.fps"))) / F.col("all_pos")).alias("tpr"))
    end = totals.select(fold, F.lit(last).cast("bigint").alias("i"), F.lit(1.0).alias("tpr"))
    mean = inner.unionByName(end).groupBy("i").agg(F.avg("tpr").alias("tpr"))
    return mean.select(F.col("i").cast("int").alias("i"), (F.col("i") / last).alias("fpr"), F.when(F.col("i") == 0, 0.0).otherwise(F.col("tpr")).alias("tpr"))


def confusion_counts(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def confusion_matrix(df: DataFrame, actual: str, predicted: str, classes: list) -> DataFrame:
    wide = df.groupBy(F.col(actual).alias("actual")).pivot(predicted, classes).count()
    return wide.na.fill(0)


def class_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class, and their support-weighted mean."""
    cells = confusion_counts(df, actual, predicted)
    role = F.explode(F.array(F.struct(F.col("actual").cast("string").alias("class"), F.lit(1).alias("is_actual")),
                             F.struct(F.col("predicted").cast("string").alias("class"), F.lit(0).alias("is_actual"))))
    sides = cells.select(role.alias("s"), "n", (F.col("actual") == F.col("predicted")).alias("hit")).select("s.*", "n", "hit")
    sums = sides.groupBy("class").agg(
        F.sum(F.when((F.col("is_actual") == 1), F.col("n")).otherwise(0)).alias("support"),
        F.sum(F.when((F.col("is_actual") == 0), F.col("n")).otherwise(0)).alias("called"),
        F.sum(F.when((F.col("is_actual") == 1) & F.col("hit"), F.col("n")).otherwise(0)).alias("hits"))
    p, r = F.coalesce(F.try_divide("hits", "called"), F.lit(0.0)), F.coalesce(F.try_divide("hits", "support"), F.lit(0.0))
    report = sums.select("class", p.alias("precision"), r.alias("recall"), F.coalesce(F.try_divide(p * r * 2, p + r), F.lit(0.0)).alias("f1"), "support")
    weighted = lambda c: (F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(c)
    mean = report.agg(F.lit("avg / total").alias("class"), weighted("precision"), weighted("recall"), weighted("f1"), F.sum("support").alias("support"))
    return report.unionByName(mean)


def classification_scores(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    hit = F.avg((F.col(actual) == F.col(predicted)).cast("double"))
    return df.agg(hit.alias("accuracy"), (1 - hit).alias("hamming_loss"), (hit * 100).alias("classif_rate"))


def regression_scores(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    y, e = F.col(actual).cast("double"), F.col(actual).cast("double") - F.col(predicted)
    return df.agg(F.avg(e * e).alias("mse"), (1 - F.sum(e * e) / (F.var_pop(y) * F.count("*"))).alias("r2"))


TERMS = 65_536  # summands of the expected information that one row stands for


def _log_share(k: float, a: int, b: int, n: int) -> float:
    """Log-probability that two random groups of a and b of n rows share k."""
    g = math.lgamma
    return g(a + 1) + g(b + 1) + g(n - a + 1) + g(n - b + 1) - g(n + 1) - g(k + 1) - g(a - k + 1) - g(b - k + 1) - g(n - a - b + k + 1)


def _information_of_range(a: int, b: int, n: int, low: int, terms: int = TERMS) -> float:
    """Summands low .. low + terms - 1 of the expected information of groups of a and b rows; 0 where all of them underflow."""
    high = min(low + terms - 1, a, b)
    mode = (a + 1.0) * (b + 1.0) / (n + 2.0)
    if _log_share(min(max(mode, low), high), a, b, n) < -760.0:  # the largest term of the range
        return 0.0
    k = np.arange(low, high + 1, dtype="float64")
    up = np.log(a - k[:-1]) + np.log(b - k[:-1]) - np.log(k[:-1] + 1) - np.log(n - a - b + k[:-1] + 1)
    logs = _log_share(low, a, b, n) + np.concatenate([[0.0], np.cumsum(up)])
    return float((k / n * np.log(n * k / (a * float(b))) * np.exp(logs)).sum())


def expected_information(sizes_a: DataFrame, sizes_b: DataFrame, n: int) -> float:
    """Expected mutual information of random groupings; sizes are (a, ma) and (b, mb) with how many groups have them.

    Distinct sizes are paired, at most about the root of 2 n on either side, and each pair is
    cut into ranges of TERMS summands, so a row's work is bounded however large its groups are.
    """
    terms = TERMS
    low = F.greatest(F.lit(1).cast("bigint"), F.col("a") + F.col("b") - F.lit(n))
    ranges = sizes_a.crossJoin(sizes_b).select("a", "b", (F.col("ma") * F.col("mb")).alias("m"), F.explode(F.sequence(low, F.least("a", "b"), F.lit(terms).cast("bigint"))).alias("low"))

    @F.pandas_udf("double")
    def summed(a: pd.Series, b: pd.Series, low: pd.Series) -> pd.Series:
        return pd.Series([_information_of_range(int(x), int(y), n, int(k), terms) for x, y, k in zip(a, b, low)], dtype="float64")

    return ranges.repartition("a", "b", "low").agg(F.sum(summed("a", "b", "low") * F.col("m"))).first()[0] or 0.0


def cluster_scores(df: DataFrame, truth: str, cluster: str) -> DataFrame:
    """Homogeneity, completeness, V-measure, adjusted Rand and adjusted mutual information
    (normalised by the larger entropy), all from the contingency table.

    Entropies and information are differences of sums of v ln v over the table and its two
    margins, so one pass of grouped counts gives them without a join.
    """
    table = cut(df.groupBy(F.col(truth).alias("c"), F.col(cluster).alias("k")).agg(F.count("*").alias("v")))
    rows, cols = table.groupBy("c").agg(F.sum("v").alias("v")), table.groupBy("k").agg(F.sum("v").alias("v"))
    sides = [t.select(F.lit(name).alias("side"), "v") for name, t in (("cells", table), ("rows", rows), ("cols", cols))]
    sums = sides[0].unionByName(sides[1]).unionByName(sides[2]).groupBy("side", "v").agg(F.count("*").alias("m"))
    sums = cut(sums)
    totals = sums.groupBy("side").agg(F.sum(F.col("v") * F.col("m")).alias("n"), F.sum(F.col("m") * F.col("v") * F.log("v")).alias("logs"), F.sum(F.col("m") * F.col("v") * (F.col("v") - 1) / 2.0).alias("pairs"))
    by_side = {r["side"]: r for r in totals.collect()}
    if not by_side:
        return df.sparkSession.createDataFrame([(1.0, 1.0, 1.0, 1.0, 1.0)], "homogeneity double, completeness double, v_measure double, ari double, ami double")
    n = by_side["cells"]["n"]
    logs = {side: r["logs"] / n for side, r in by_side.items()}
    hc, hk = math.log(n) - logs["rows"], math.log(n) - logs["cols"]
    mi = math.log(n) + logs["cells"] - logs["rows"] - logs["cols"]
    pairs, pc, pk = (by_side[s]["pairs"] for s in ("cells", "rows", "cols"))
    sizes = lambda side, v, m: sums.where(F.col("side") == side).select(F.col("v").alias(v), F.col("m").alias(m))
    emi = expected_information(sizes("rows", "a", "ma"), sizes("cols", "b", "mb"), n)
    homogeneity = mi / hc if hc else 1.0
    completeness = mi / hk if hk else 1.0
    v = 2 * homogeneity * completeness / (homogeneity + completeness) if homogeneity + completeness else 0.0
    by_chance, top = pc * pk / max(n * (n - 1) / 2.0, 1.0), (pc + pk) / 2.0
    ari = (pairs - by_chance) / (top - by_chance) if top != by_chance else 1.0
    ami = (mi - emi) / (max(hc, hk) - emi) if max(hc, hk) != emi else 1.0
    drop_cut(table, sums)
    return df.sparkSession.createDataFrame([(homogeneity, completeness, v, ari, ami)],
                                           "homogeneity double, completeness double, v_measure double, ari double, ami double")


def silhouette_rows(df: DataFrame, key: str, vector: str, cluster: str) -> DataFrame:
    """Silhouette of every row under squared Euclidean distance.

    Mean squared distances to a cluster follow from its size, mean and mean square, so no
    pair of rows is ever formed.
    """
    rows = df.select(key, cluster, as_doubles(vector).alias("_v")).withColumn("_sq", dot(F.col("_v"), F.col("_v")))
    stats = rows.groupBy(cluster).agg(F.count("*").alias("n"), Summarizer.mean(array_to_vector("_v")).alias("m"), F.avg("_sq").alias("sq"))
    known = bounded_collect(stats.orderBy(cluster), 2_000, "clusters")
    names, sizes = [r[cluster] for r in known], np.array([r["n"] for r in known], dtype="float64")
    means, squares = np.array([r["m"].toArray() for r in known]), np.array([r["sq"] for r in known])
    place = {c: i for i, c in enumerate(names)}

    @F.pandas_udf("double")
    def value(vectors: pd.Series, labels: pd.Series) -> pd.Series:
        if vectors.empty:
            return pd.Series([], dtype="float64")
        x, own = np.stack(vectors.to_numpy()), labels.map(place).to_numpy()
        at = np.arange(len(x))
        d = (x * x).sum(axis=1)[:, None] - 2 * x @ means.T + squares
        a = d[at, own] * sizes[own] / np.maximum(sizes[own] - 1, 1)
        d[at, own] = np.inf
        b = d.min(axis=1)
        top = np.maximum(a, b)
        return pd.Series(np.where((sizes[own] > 1) & (top > 0), (b - a) / np.where(top > 0, top, 1), 0.0))

    return rows.select(key, cluster, value("_v", cluster).alias("silhouette"))


def silhouette_sample(df: DataFrame, key: str, vector: str, cluster: str, size: int = 300, seed: int = 0) -> float:
    """Mean Euclidean silhouette of a bounded random sample, compared within the sample."""
    rows = df.orderBy(unit_number(F.lit(seed), F.col(key)), key).limit(size).select(as_doubles(vector), cluster).collect()
    x, c = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    d = np.sqrt(np.maximum(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1), 0))
    out = []
    for i, own in enumerate(c):
        same = (c == own) & (np.arange(len(c)) != i)
        if not same.any():
            out.append(0.0)
            continue
        a, b = d[i, same].mean(), min(d[i, c == o].mean() for o in set(c.tolist()) if o != own)
        out.append((b - a) / max(a, b))
    return float(np.mean(out))

