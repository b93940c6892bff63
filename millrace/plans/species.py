"""Where a species can live: grid covariates, one-class score, AUC against background."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import evaluate
from millrace.operators.clustering import one_class_fit, one_class_score
from millrace.operators.features import standardise
from millrace.operators.geo import grid_lookup
from millrace.operators.sampling import random_cells, split_by_hash


def run(points: DataFrame, cells: DataFrame, layers: list[str], x0: float, y0: float, step: float, columns: int, rows: int,
        species: list[str], steps: int = 8) -> DataFrame:
    """(species, n_train, n_test, auc); auc is null without training or test rows. `points` has point_id, kind, lat, lng; `cells` has ix, iy
    and the covariate layers. Covariates are scaled by the training points of the species."""
    spark = points.sparkSession
    known = standardise(cells.na.fill(0.0, layers), layers).select("ix", "iy", F.array(*layers).alias("x"))
    located = split_by_hash(grid_lookup(points, known, x0, y0, step).where("x is not null"), "point_id", 0.7).cache()
    background = random_cells(points.select("point_id"), "point_id", columns, rows, 13).join(known, ["ix", "iy"]).select("x").cache()
    out = []
    for name in species:
        train = located.where((F.col("kind") == name) & (F.col("part") == "train")).select("x")
        test = located.where((F.col("kind") == name) & (F.col("part") == "test")).select("x")
        n_train, n_test = train.count(), test.count()
        if not n_train:
            out.append((name, 0, n_test, None))
            continue
        model = one_class_fit(train, "x", len(layers), nu=0.5, gamma=0.5, components=40, steps=steps)
        both = test.withColumn("here", F.lit(True)).unionByName(background.withColumn("here", F.lit(False)))
        scored = one_class_score(both, "x", model)
        score = evaluate.auc(scored, "score", "here") if n_test else None
        out.append((name, n_train, n_test, None if score is None else float(score)))
    located.unpersist()
    background.unpersist()
    return spark.createDataFrame(out, "species string, n_train bigint, n_test bigint, auc double")
