"""Supervised models."""

from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from millrace.catalog import query
from millrace.catalog.evaluations import accuracy, vectors
from millrace.functions.scalars import rounded
from millrace.operators import features, models, sampling, selection, text, tuning
from millrace.operators.isotonic import isotonic_fit
from millrace.operators.sampling import split_by_hash

SPLIT = """, e as (select vec_id, label, embedding::double[] as v, cast('0x' || substr(md5('0:' || cast(vec_id as varchar)), 1, 15) as bigint) / 1152921504606846976.0e0 < 0.7 as is_train from embeddings)"""


def _split(t, classes=None):
    marked = split_by_hash(vectors(t, classes), "vec_id", 0.7)
    return marked.where("part = 'train'").drop("part"), marked.where("part = 'test'").drop("part")


def _raw_split(t):
    marked = split_by_hash(t.embeddings, "vec_id", 0.7)
    return marked.where("part = 'train'"), marked.where("part = 'test'")


@query("linear_regression", """
select round(regr_slope(l_extendedprice, l_quantity), 4) as slope, round(regr_intercept(l_extendedprice, l_quantity), 3) as intercept, round(regr_r2(l_extendedprice, l_quantity), 8) as r2,
  round((regr_syy(l_extendedprice, l_quantity) - pow(regr_sxy(l_extendedprice, l_quantity), 2) / regr_sxx(l_extendedprice, l_quantity)) / count(*), 0) as mse from lineitem""")
def _(t):
    fit = models.least_squares(t.lineitem, ["l_quantity"], "l_extendedprice")
    table = t.spark.createDataFrame([(float(fit["coefficients"][0]), fit["intercept"], fit["r2"], fit["mse"])], "slope double, intercept double, r2 double, mse double")
    return table.select(F.round("slope", 4).alias("slope"), F.round("intercept", 3).alias("intercept"), rounded(F.col("r2"), 8).alias("r2"), F.round("mse", 0).alias("mse"))


@query("ridge")
def _(t):
    columns = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
    ridge = models.least_squares(t.lineitem, columns, "l_extendedprice", alpha=1.0)
    net = LinearRegression(regParam=0.1, elasticNetParam=0.5, maxIter=10).fit(selection.assembled(t.lineitem, columns, "l_extendedprice"))
    rows = [(c, float(a), float(b)) for c, a, b in zip(columns, ridge["coefficients"], net.coefficients.toArray())]
    return t.spark.createDataFrame(rows, "name string, ridge double, elastic_net double")


@query("isotonic", """
, p as (select l_quantity::double as x, count(*) as w, sum(l_extendedprice) as t from lineitem group by 1),
  c as (select x, sum(w) over (order by x) as w, sum(t) over (order by x) as t, sum(w) over (order by x) - w as w0, sum(t) over (order by x) - t as t0 from p),
  m as (select i.x as x, j.x as j, min((k.t - j.t0) / (k.w - j.w0)) as low from c i join c j on j.x <= i.x join c k on k.x >= i.x group by 1, 2)
select x as boundary, round(max(low), 4) + 0.0 as fitted from m group by 1""")
def _(t):
    return isotonic_fit(t.lineitem, "l_quantity", "l_extendedprice").withColumn("fitted", rounded(F.col("fitted"), 4))


@query("boosted_regression")
def _(t):
    data = selection.assembled(t.features_wide.withColumnRenamed("label", "big"), ["p_size", "age", "name_len", "big"], "p_retailprice")
    marked = data.withColumn("_t", sampling.unit_number(F.lit(0), F.xxhash64("features", "label")) < 0.7)
    model = GBTRegressor(maxIter=8, maxDepth=3, stepSize=0.3, seed=0).fit(marked.where("_t"))
    losses = model.evaluateEachIteration(marked.where("not _t"), "squared")
    return t.spark.createDataFrame([(i + 1, float(v)) for i, v in enumerate(losses)], "trees int, loss double")


@query("forest_regression")
def _(t):
    columns = ["age", "name_len", "big"]
    raw = t.features_wide.withColumnRenamed("label", "big").select("id", *columns, "p_retailprice")
    forest = RandomForestRegressor(numTrees=10, maxDepth=4, seed=0)
    r2 = RegressionEvaluator(metricName="r2")
    out = []
    for name, rows in (("rows without gaps", raw.dropna(subset=["age"])), ("mean filled", features.impute_mean(raw, ["age"]))):
        data = selection.assembled(rows, columns, "p_retailprice").withColumn("id", F.xxhash64("features", "label"))
        score = tuning.cross_val_scores(data, "id", forest, r2, 2).agg(F.avg("score")).first()[0]
        out.append((name, float(score)))
    return t.spark.createDataFrame(out, "variant string, r2 double")


@query("logistic")
def _(t):
    train, test = _split(t, 2)
    train = train.cache()
    n, out = train.count(), []
    for c in (100.0, 1.0, 0.01):
        for name, mix in (("l1", 1.0), ("l2", 0.0)):
            model = LogisticRegression(elasticNetParam=mix, regParam=1 / (c * n), maxIter=15).fit(train)
            zero = float((model.coefficients.toArray() == 0).mean())
            out.append((c, name, zero, float(accuracy().evaluate(model.transform(test)))))
    train.unpersist()
    return t.spark.createDataFrame(out, "c double, penalty string, zero_share double, accuracy double")


@query("linear_svc")
def _(t):
    rows = vectors(t).withColumn("label", (F.col("label") == 0).cast("double")).withColumn("w", F.when(F.col("label") > 0, 10.0).otherwise(1.0))
    plain, weighted = LinearSVC(maxIter=10, regParam=0.01), LinearSVC(maxIter=10, regParam=0.01, weightCol="w")
    first = plain.fit(rows).transform(rows).select("vec_id", "features", "label", "w", F.col("prediction").alias("plain"))
    return weighted.fit(rows).transform(first).select("vec_id", "label", "plain", F.col("prediction").alias("weighted"))


@query("one_vs_rest")
def _(t):
    train, test = _split(t)
    model = OneVsRest(classifier=LogisticRegression(maxIter=5, regParam=0.01), parallelism=4).fit(train)
    return model.transform(test).select("vec_id", "label", "prediction", features.to_array("rawPrediction").alias("scores"))


@query("sgd_classifiers")
def _(t):
    marked = split_by_hash(t.embeddings.withColumn("y", (F.col("label") < 5).cast("int")), "vec_id", 0.7)
    train, test = marked.where("part = 'train'"), marked.where("part = 'test'")
    out = None
    weights = {k: models.averaged_learner(train, "embedding", "y", k, passes=6) for k in ("hinge", "perceptron", "passive_aggressive")}
    weights["ridge"] = models.ridge_classifier(train, "embedding", "y")
    for name, w in weights.items():
        scored = test.agg(F.lit(name).alias("model"), F.count("*").alias("n"), F.avg((models.linear_prediction("embedding", w) == F.col("y")).cast("double")).alias("accuracy"))
        out = scored if out is None else out.unionByName(scored)
    return out


@query("naive_bayes", """
, tok as (select doc_id, label, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) as term from labelled), cnt as (select doc_id, label, term, count(*) as n from tok group by 1, 2, 3),
  tc as (select label, term, sum(n) as n from cnt group by 1, 2), cs as (select label, sum(n) as s from tc group by 1), pr as (select label, ln(count(*) / (select count(*) from labelled)) as p from labelled group by 1),
  voc as (select count(distinct term) as v from cnt),
  sc as (select c.doc_id, cs.label, max(p) + sum(c.n * ln((coalesce(tc.n, 0) + 1.0e0) / (s + v))) as score from cnt c cross join cs join pr on pr.label = cs.label cross join voc left join tc on tc.label = cs.label and tc.term = c.term group by 1, 2)
select doc_id, arg_max(label, score) as prediction, round(max(score), 4) as score from sc group by 1""", "labelled")
def _(t):
    docs = t.labelled
    counts = text.term_counts(docs, "doc_id", text.words(F.col("text")))
    return models.multinomial_bayes(counts, docs.select("doc_id", "label"), "doc_id").withColumn("score", rounded(F.col("score"), 4))


@query("decision_tree")
def _(t):
    train, test = _split(t)
    return DecisionTreeClassifier(maxDepth=5, seed=0).fit(train).transform(test).select("vec_id", "label", "prediction")


@query("random_forest")
def _(t):
    train, test = _split(t)
    return RandomForestClassifier(maxDepth=5, numTrees=20, seed=0).fit(train).transform(test).select("vec_id", "label", "prediction", features.to_array("probability").alias("probability"))


@query("adaboost")
def _(t):
    train, test = _split(t, 2)
    return models.boosted_prediction(test, models.adaboost(train, 5)).select("vec_id", "label", "prediction")


@query("neural_net")
def _(t):
    train, test = _split(t)
    model = MultilayerPerceptronClassifier(layers=[64, 20, 10], maxIter=20, seed=0).fit(train)
    return model.transform(test).select("vec_id", "label", "prediction")


@query("knn", SPLIT + """, d as (select q.vec_id, r.label, row_number() over (partition by q.vec_id order by list_distance(q.v, r.v), r.vec_id) as rn from e q, e r where not q.is_train and r.is_train),
  v as (select vec_id, label, count(*) as n from d where rn <= 15 group by 1, 2)
select vec_id, arg_max(label, (n, -label)) as prediction from v group by 1""")
def _(t):
    train, test = _raw_split(t)
    return models.knn(train, test, "vec_id", "embedding", "label", 15)


@query("nearest_centroid", SPLIT + """, lv as (select vec_id, label, is_train, i as pos, v[i] as x from e, range(1, 65) r(i)), c as (select label, pos, avg(x) as m from lv where is_train group by 1, 2),
  d as (select q.vec_id, c.label, sum(pow(q.x - c.m, 2)) as d from lv q join c on c.pos = q.pos where not q.is_train group by 1, 2)
select vec_id, arg_min(label, (round(d, 10), label)) as prediction from d group by 1""")
def _(t):
    train, test = _raw_split(t)
    return models.nearest_centroid(train, test, "vec_id", "embedding", "label")


@query("quadratic_discriminant", """
, x as (select id, label, p_size::double as a, p_retailprice / 100 as b from features_wide),
  m as (select label, avg(a) as ma, avg(b) as mb, var_samp(a) as vaa, var_samp(b) as vbb, covar_samp(a, b) as vab, ln(count(*) / (select count(*) from x)) as pr from x group by 1),
  s as (select id, m.label, pr - 0.5 * ln(vaa * vbb - vab * vab) - 0.5 * ((a - ma) * (a - ma) * vbb - 2 * (a - ma) * (b - mb) * vab + (b - mb) * (b - mb) * vaa) / (vaa * vbb - vab * vab) as score from x, m)
select id, arg_max(label, score) as prediction, round(max(score), 6) as log_likelihood from s group by 1""", "features_wide")
def _(t):
    rows = t.features_wide.select("id", "label", F.array(F.col("p_size").cast("double"), F.col("p_retailprice") / 100).alias("v"))
    return models.quadratic_discriminant(rows, rows, "id", "v", "label").withColumn("log_likelihood", rounded(F.col("log_likelihood"), 6))
