"""Feature ranking and selection."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import LinearSVC, LogisticRegression, OneVsRest, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import tails
from millrace.operators.aggregates import unpivot

# How many features a ranking reports.
TOP = 10


def _long(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    return df.select(F.col(label).alias("_y"), *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(["_y"], columns, "name", "x")


def _class_sums(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """n, sum, mean and variance per (feature, class); features as rows only after grouping."""
    sums = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("s", F.sum), ("m", F.avg), ("v", F.var_pop))]
    wide = df.select(F.col(label).alias("_y"), *[F.col(c).cast("double").alias(c) for c in columns]).groupBy("_y").agg(F.count("*").alias("n"), *sums)
    cells = ", ".join(f"'{c}', `s_{c}`, `m_{c}`, `v_{c}`" for c in columns)
    return wide.selectExpr("_y", "n", f"stack({len(columns)}, {cells}) as (name, s, mean, variance)")


def chi2_rank(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """Chi-square of class sums against the sums expected from the class shares."""
    sums = _class_sums(df, columns, label)
    totals = sums.groupBy("name").agg(F.sum("s").alias("all_s"), F.sum("n").alias("all_n"), F.count("*").alias("classes"))
    gap = F.col("all_s") * F.col("n") / F.col("all_n")
    scored = sums.join(totals, "name").groupBy("name").agg(
        F.sum(F.try_divide((F.col("s") - gap) * (F.col("s") - gap), gap)).alias("chi2"), (F.max("classes") - 1).alias("dof"))
    return scored.withColumn("pvalue", tails.as_column(tails.chi2_tail, F.col("chi2"), F.col("dof"))).orderBy(F.desc("chi2"), "name")


def pearson_rank(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """Signed correlation with the label, highest first."""
    y = F.col(label).cast("double")
    wide = df.agg(F.count(label).alias("n"), *[F.corr(F.col(c).cast("double"), y).alias(c) for c in columns])
    cells = ", ".join(f"'{c}', `{c}`" for c in columns)
    long = wide.selectExpr("n", f"stack({len(columns)}, {cells}) as (name, pearsonr)")
    return long.select("name", "pearsonr", tails.as_column(tails.r_tail, F.col("pearsonr"), F.col("n")).alias("pvalue")).orderBy(F.desc("pearsonr"), "name")


def mutual_info_rank(df: DataFrame, columns: list[str], label: str, bins: int = 10) -> DataFrame:
    """Mutual information (nats) of each feature, cut into equal-width bins, with the label.

    Only the contingency table, at most features x bins x classes rows, leaves the first pass.
    """
    edges = unpivot(df, columns).groupBy("name").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    cell = F.when(width > 0, F.least(F.floor((F.col("x") - F.col("lo")) / width), F.lit(bins - 1))).otherwise(0)
    binned = _long(df, columns, label).where("x is not null").join(F.broadcast(edges), "name").withColumn("bin", cell)
    joint = binned.groupBy("name", "bin", "_y").agg(F.count("*").alias("n"))
    by_bin = joint.groupBy("name", "bin").agg(F.sum("n").alias("nb"))
    by_class = joint.groupBy("name", "_y").agg(F.sum("n").alias("nc"))
    all_rows = joint.groupBy("name").agg(F.sum("n").alias("nn"))
    table = joint.join(by_bin, ["name", "bin"]).join(by_class, ["name", "_y"]).join(all_rows, "name")
    part = F.col("n") / F.col("nn") * F.log(F.col("n") * F.col("nn") / (F.col("nb") * F.col("nc")))
    return table.groupBy("name").agg(F.sum(part).alias("mutual_information")).orderBy(F.desc("mutual_information"), "name")


def anova_f(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """One-way F statistic per feature, from class means around the mean of all and class variances."""
    sums = _class_sums(df, columns, label)
    # Means are added around the first class's, so a large mean costs no digits.
    base = sums.groupBy("name").agg(F.min_by("mean", "_y").alias("base"))
    centre = sums.join(base, "name").groupBy("name").agg((F.first("base") + F.sum(F.col("n") * (F.col("mean") - F.col("base"))) / F.sum("n")).alias("centre"))
    gap = F.col("mean") - F.col("centre")
    folded = sums.join(centre, "name").groupBy("name").agg(F.sum("n").alias("n"), F.count("*").alias("k"), F.sum(F.col("n") * F.col("variance")).alias("within"), F.sum(F.col("n") * gap * gap).alias("between"))
    between, within = F.col("between"), F.col("within")
    dof1, dof2 = F.col("k") - 1, F.col("n") - F.col("k")
    scored = folded.select("name", F.try_divide(between / dof1, within / dof2).alias("f"), dof1.alias("dof1"), dof2.alias("dof2"))
    return scored.withColumn("pvalue", tails.as_column(tails.f_tail, F.col("f"), F.col("dof1"), F.col("dof2"))).orderBy(F.desc("f"), "name")


def regression_f(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """F of the one-variable regression on a numeric target."""
    ranked = pearson_rank(df, columns, target)
    n = df.where(F.col(target).isNotNull()).count()
    r2 = F.col("pearsonr") * F.col("pearsonr")
    return ranked.select("name", (r2 / (1 - r2) * (n - 2)).alias("f"), "pvalue").orderBy(F.desc("f"), "name")


def keep_best(df: DataFrame, ranking: DataFrame, columns: list[str], k: int) -> DataFrame:
    """Drop all ranked columns but the first k."""
    best = {r["name"] for r in ranking.limit(k).collect()}
    return df.drop(*[c for c in columns if c not in best])


def variances(df: DataFrame, columns: list[str], threshold: float) -> DataFrame:
    """Population variance per column and whether it is above the threshold."""
    wide = df.agg(*[F.var_pop(F.col(c).cast("double")).alias(c) for c in columns])
    cells = ", ".join(f"'{c}', `{c}`" for c in columns)
    return wide.selectExpr(f"stack({len(columns)}, {cells}) as (name, variance)").withColumn("kept", F.col("variance") > threshold)


def assembled(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    filled = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns], F.col(label).cast("double").alias("label"))
    return VectorAssembler(inputCols=columns, outputCol="features").transform(filled)


def tree_rank(df: DataFrame, columns: list[str], label: str, trees: int = 10, depth: int = 5, seed: int = 0) -> DataFrame:
    """Random-forest importance per feature, with its spread over the trees."""
    model = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed).fit(assembled(df, columns, label))
    per_tree = np.array([t.featureImportances.toArray() for t in model.trees])
    rows = [(c, float(v), float(s)) for c, v, s in zip(columns, model.featureImportances.toArray(), per_tree.std(axis=0))]
    return df.sparkSession.createDataFrame(rows, "name string, importance double, spread double").orderBy(F.desc("importance"), "name")


def lasso_select(df: DataFrame, columns: list[str], target: str, most: int = 2, step: float = 0.1) -> tuple[list[str], float]:
    """Fit a lasso with a cross-validated penalty, then raise the coefficient threshold by
    `step` until at most `most` features are left. Returns the names and the threshold."""
    data = assembled(df, columns, target).cache()
    lasso = LinearRegression(elasticNetParam=1.0, standardization=True)
    search = CrossValidator(estimator=lasso, estimatorParamMaps=ParamGridBuilder().addGrid(lasso.regParam, [0.001, 0.01, 0.1]).build(),
                            evaluator=RegressionEvaluator(metricName="rmse"), numFolds=3, seed=0, parallelism=3)
    weights = np.abs(search.fit(data).bestModel.coefficients.toArray())
    data.unpersist()
    threshold = 0.25
    kept = [c for c, w in zip(columns, weights) if w >= threshold]
    while len(kept) > most:
        threshold += step
        kept = [c for c, w in zip(columns, weights) if w >= threshold]
    return kept, threshold


def l1_select_then_svc(train: DataFrame, test: DataFrame, penalty: float = 0.01):
    """Non-zero features of an L1 logistic model, refitted by a linear SVM on them alone.

    `train` and `test` hold `features` and a 0/1 `label`. Returns (indices, scored test).
    """
    sparse = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=50).fit(train)
    kept = np.flatnonzero(sparse.coefficients.toArray()).tolist() or [0]
    slicer = VectorSlicer(inputCol="features", outputCol="kept", indices=kept)
    model = Pipeline(stages=[slicer, LinearSVC(featuresCol="kept", maxIter=30, regParam=0.01)]).fit(train)
    return kept, model.transform(test)


def eliminate_features(df: DataFrame, columns: list[str], label: str, folds: int = 2, seed: int = 0) -> DataFrame:
    """Recursive elimination: drop the weakest feature of a linear SVM, one per step, and
    report the cross-validated accuracy for each number of features."""
    data = assembled(df, columns, label).select("features", "label").cache()
    classes = data.select("label").distinct().count()
    base = LinearSVC(maxIter=10, regParam=0.01)
    accuracy = MulticlassClassificationEvaluator(metricName="accuracy")
    left, out = list(range(len(columns))), []
    while left:
        view = VectorSlicer(inputCol="features", outputCol="kept", indices=left).transform(data).select(F.col("kept").alias("features"), "label")
        learner = base if classes == 2 else OneVsRest(classifier=base)
        search = CrossValidator(estimator=learner, estimatorParamMaps=[{}], evaluator=accuracy, numFolds=folds, seed=seed, parallelism=folds).fit(view)
        score, model = search.avgMetrics[0], search.bestModel
        weights = np.array([m.coefficients.toArray() for m in (model.models if classes > 2 else [model])])
        weakest = left[int(np.argmin((weights ** 2).sum(axis=0)))]
        out.append((len(left), float(score), columns[weakest]))
        left.remove(weakest)
    data.unpersist()
    return df.sparkSession.createDataFrame(out, "n_features int, accuracy double, dropped_next string")
