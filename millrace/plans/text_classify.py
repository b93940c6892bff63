"""Vectorise, select terms, train a list of classifiers, one table of scores.

Documents become (key, i, value) rows once; blocks of them train all linear models by the same
passes, and one join of the held-out rows with one weight row per term scores all of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators import sparse, text
from millrace.operators.ordered import dense_index
from millrace.operators.sparse import INTERCEPT, Learner
from millrace.session import cut, drop_cut

BUCKETS = 1 << 16

# Trained side by side; C = 1 for the support vector machines.
LINEAR = [
    Learner("perceptron", "perceptron"), Learner("passive aggressive", "passive_aggressive"),
    Learner("svc l2", "squared_hinge", 1.0, per_row=True), Learner("sgd l2", "hinge", 1e-4),
    Learner("svc l1", "squared_hinge", 1.0, 1.0, per_row=True), Learner("sgd l1", "hinge", 1e-4, 1.0),
    Learner("sgd elastic net", "hinge", 1e-4, 0.15)]
SELECTED = Learner("l1 select, svc l2", "squared_hinge", 1.0, per_row=True)


def chi2_terms(weights: DataFrame, labels: DataFrame, key: str, k: int) -> DataFrame:
    """(term): the k terms whose summed weights differ most between the classes (chi-square)."""
    joined = weights.join(labels, key)
    observed = joined.groupBy("term", "label").agg(F.sum("weight").alias("o"))
    shares = labels.groupBy("label").agg(F.count("*").alias("c"))
    total = labels.count()
    per_term = observed.groupBy("term").agg(F.sum("o").alias("all_o"))
    # a class without the term contributes its expected value
    gap = F.col("all_o") * F.col("c") / total
    scored = observed.join(per_term, "term").join(shares, "label").groupBy("term").agg(
        F.sum((F.col("o") - gap) * (F.col("o") - gap) / gap).alias("seen"), F.sum(gap).alias("covered"), F.first("all_o").alias("all_o"))
    ranked = scored.select("term", (F.col("seen") + F.col("all_o") - F.col("covered")).alias("chi2")).orderBy(F.desc("chi2"), "term")
    return ranked.limit(k).select("term")


def tokens(column: Column, stop_words: bool) -> Column:
    return text.without(text.words(column), StopWordsRemover.loadDefaultStopWords("english") if stop_words else [])


def unit_rows(weighted: DataFrame, keys: list[str]) -> DataFrame:
    """(keys.., i, value) scaled to unit length per document, from (keys.., i, w)."""
    norms = weighted.groupBy(*keys).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return weighted.join(norms, keys).select(*keys, "i", F.when(F.col("norm") > 0, F.col("w") / F.col("norm")).otherwise(0.0).alias("value"))


def vocabulary(counts: DataFrame, documents: int, max_df: float, terms: DataFrame | None = None) -> DataFrame:
    """(term, i, idf) of the terms in at most max_df of the documents, numbered from 0 without passing through the driver."""
    kept = text.document_frequency(counts).where(F.col("df") <= max_df * documents)
    if terms is not None:
        kept = kept.join(terms, "term", "left_semi")
    kept = cut(kept.select("term", (F.log((documents + 1.0) / (F.col("df") + 1.0)) + 1).alias("idf")))
    return cut(dense_index(kept, "term", "i").join(kept, "term").select("term", F.col("i").cast("bigint").alias("i"), "idf"))


def run(train: DataFrame, test: DataFrame, key: str = "doc_id", terms: int | None = None, max_df: float = 0.5, stop_words: bool = True, hashing: bool = False,
        rounds: int = 3, passes: int = 17, neighbours: int = 10, trees: int = 100) -> DataFrame:
    """(model, n_test, accuracy, f1, density) of fourteen classifiers of 0/1 labels on terms of the training documents.

    Terms in more than max_df of the training documents and English stop words are left out;
    weights are sublinear counts times idf, of unit length. With `terms`, only so many terms of
    the highest chi-square are kept; with `hashing`, counts in BUCKETS hashed terms take the
    place of a vocabulary. Linear models make rounds * passes passes. density is the share of
    features with a coefficient that is not 0, where a model has coefficients.
    """
    spark = train.sparkSession
    split = cut(train.withColumn("held", F.lit(False)).unionByName(test.withColumn("held", F.lit(True))).select(key, "label", "held", F.explode_outer(tokens(F.col("text"), stop_words)).alias("term")))
    documents = cut(split.groupBy(key, "held").agg(F.first("label").cast("double").alias("label")).withColumn("run", F.lit("")))
    counts = split.where("term is not null").groupBy(key, "held", "term").agg(F.count("*").alias("n"))
    labels, held_labels = documents.where("not held").drop("held"), documents.where("held").drop("held")
    if hashing:
        hashed = counts.groupBy(key, "held", F.pmod(F.xxhash64("term"), F.lit(BUCKETS)).alias("i")).agg(F.sum("n").cast("double").alias("w"))
        hashed = cut(hashed)
        used = cut(dense_index(hashed.where("not held"), "i", "_at"))  # only buckets in use, from which the forest draws
        size = used.count()
        weighted = cut(hashed.join(used, "i").select(key, "held", F.col("_at").cast("bigint").alias("i"), "w"))
    else:
        counts = cut(counts)
        own, n = counts.where("not held"), labels.count()
        chosen = chi2_terms(text.tfidf(own, key, n, sublinear=True), labels.select(key, "label"), key, terms) if terms is not None else None
        known = vocabulary(own, n, max_df, chosen)
        size = known.count()
        weighted = cut(counts.join(known, "term").select(key, "held", "i", ((F.log("n") + 1) * F.col("idf")).alias("w")))
    shaped = cut(unit_rows(weighted, [key, "held"]).withColumn("run", F.lit("")))
    entries, held_entries = shaped.where("not held").drop("held"), shaped.where("held").drop("held")
    packed, held = sparse.blocks(entries, labels, key), sparse.blocks(held_entries, held_labels, key)
    linear = sparse.fit_linear(packed, LINEAR, rounds, passes)
    # Second step of the last model: the terms that the absolute penalty leaves.
    kept = linear.where(F.col("w")[[m.name for m in LINEAR].index("svc l1")] != 0).where(F.col("i") != INTERCEPT).select("i")
    chosen_blocks = sparse.blocks(cut(entries.join(kept, "i", "left_semi").select("run", key, "i", "value")), labels, key)
    parts = [(linear, [m.name for m in LINEAR]), (sparse.fit_linear(chosen_blocks, [SELECTED], rounds, passes), [SELECTED.name]), (sparse.fit_ridge(packed), ["ridge"]),
             (sparse.bayes_weights(entries, labels, key, 0.01, flags=False), ["multinomial bayes"]), (sparse.centroid_weights(entries, labels, key), ["nearest centroid"])]
    by_value = _side_by_side(parts)
    names = [n for _, part in parts for n in part]
    scored = sparse.margins(held_entries, held_labels, by_value, key, len(names)).select(key, F.posexplode("margins").alias("m", "margin"))
    flagged = _side_by_side([(sparse.bayes_weights(entries, labels, key, 0.01, flags=True), ["bernoulli bayes"])])
    present = sparse.margins(held_entries, held_labels, flagged, key, 1, flags=True).select(key, F.lit(len(names)).alias("m"), F.col("margins")[0].alias("margin"))
    model_names = F.array(*[F.lit(n) for n in [*names, "bernoulli bayes"]])
    judged = scored.unionByName(present).select(F.get(model_names, F.col("m")).alias("model"), F.col(key).alias("key"), F.when(F.col("margin") > 0, 1.0).otherwise(0.0).alias("prediction"))
    judged = judged.unionByName(sparse.knn_votes(packed, held, neighbours).select(F.lit("nearest neighbours").alias("model"), "key", "prediction"))
    forest = sparse.fit_forest(packed, size, trees)
    judged = judged.unionByName(sparse.forest_votes(held, forest).select(F.lit("random forest").alias("model"), "key", "prediction"))
    filled = [F.sum((F.col("w")[m] != 0).cast("bigint")).alias(f"d{m}") for m in range(len(names))]
    density = by_value.where(F.col("i") != INTERCEPT).agg(*filled).first()
    shares = spark.createDataFrame([(n, (density[m] or 0) / max(size, 1)) for m, n in enumerate(names) if n not in ("multinomial bayes", "nearest centroid")], "model string, density double")
    out = cut(scores(judged.join(held_labels.select(F.col(key).alias("key"), "label"), "key")).join(F.broadcast(shares), "model", "left").select("model", "n_test", "accuracy", "f1", "density"))
    drop_cut(split, counts, weighted, shaped, packed, held, chosen_blocks, linear)
    return out


def _side_by_side(parts: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    """(run, i, w) of several models as one row per feature; a feature that a model lacks weighs nothing."""
    width, at, frames = sum(len(n) for _, n in parts), 0, []
    for frame, names in parts:
        columns = [F.col("w")[m - at] if at <= m < at + len(names) else F.lit(0.0) for m in range(width)]
        frames.append(frame.select("run", "i", *[c.alias(f"w{m}") for m, c in enumerate(columns)]))
        at += len(names)
    joined = reduce(DataFrame.unionByName, frames).groupBy("run", "i").agg(*[F.sum(f"w{m}").alias(f"w{m}") for m in range(width)])
    return cut(joined.select("run", "i", F.array(*[f"w{m}" for m in range(width)]).alias("w")))


def scores(judged: DataFrame, keys: tuple[str, ...] = ("model",)) -> DataFrame:
    """(keys.., n_test, accuracy, f1) from (keys.., label, prediction), f1 weighted by the classes' sizes."""
    cells = judged.groupBy(*keys, "label", "prediction").agg(F.count("*").alias("n"))
    right = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0))
    of_label = cells.groupBy(*keys, F.col("label").alias("c")).agg(F.sum("n").alias("support"), right.alias("hits"))
    of_guess = cells.groupBy(*keys, F.col("prediction").alias("c")).agg(F.sum("n").alias("guessed"))
    both = of_label.join(of_guess, [*keys, "c"], "left")
    f1 = 2 * F.col("hits") / (F.col("support") + F.coalesce("guessed", F.lit(0)))
    return both.groupBy(*keys).agg(F.sum("support").alias("n_test"), (F.sum("hits") / F.sum("support")).alias("accuracy"), (F.sum(f1 * F.col("support")) / F.sum("support")).alias("f1"))
