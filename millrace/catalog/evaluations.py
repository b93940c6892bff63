"""Model selection and evaluation."""

from pyspark.ml.classification import LogisticRegression, NaiveBayes, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from millrace.catalog import query
from millrace.functions.scalars import rounded
from millrace.operators import evaluate as e
from millrace.operators import prefix_search, sampling, selection, text, tuning
from millrace.operators.features import to_vector
from millrace.operators.sparse import Learner

PREDICTED = "case when l_linestatus = 'F' then 'A' when l_tax > 0.04 then 'R' else 'N' end"


def vectors(t, classes: int | None = None):
    rows = t.embeddings
    if classes == 2:
        rows = rows.withColumn("label", (F.col("label") < 5).cast("int"))
    return to_vector(rows, "embedding").select("vec_id", "features", F.col("label").cast("double").alias("label"))


def accuracy():
    return MulticlassClassificationEvaluator(metricName="accuracy")


@query("kfold", "select doc_id, label, cast((row_number() over (partition by label order by md5('0:' || cast(doc_id as varchar)), doc_id) - 1) % 6 as int) as fold from labelled", "labelled")
def _(t):
    return sampling.folds(t.labelled.select("doc_id", "label"), "doc_id", 6, "label")


@query("cross_val_score")
def _(t):
    data = selection.assembled(t.features_wide, ["p_size", "name_len"], "p_retailprice").withColumn("id", F.xxhash64("features", "label"))
    scores = tuning.cross_val_scores(data, "id", LinearRegression(), RegressionEvaluator(metricName="mse"), 5)
    summary = scores.agg(F.lit(-1).alias("fold"), F.avg("score").alias("score"))
    return scores.unionByName(summary)


@query("grid_search")
def _(t):
    """Reducer, size and cost: 36 candidates in 3 folds."""
    rows = t.embeddings.select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    lows = rows.select(F.array_min("v").alias("m")).agg(F.min("m")).first()[0] or 0.0
    return prefix_search.search_vectors(rows.withColumn("v", F.transform("v", lambda x: x - F.lit(lows))), "vec_id", "v", "label", [2, 4, 8], [1, 10, 100, 1000])


@query("grid_search_text")
def _(t):
    """Largest document frequency, n-grams, penalty and its weight: 24 candidates in 3 folds."""
    learners = prefix_search.with_costs(Learner("sgd"), [1e-5, 1e-6], [0.0, 0.15])
    return prefix_search.search_text(t.labelled, "doc_id", "label", [1, 2], [0.5, 0.75, 1.0], learners)


@query("random_search")
def _(t):
    """20 draws in 3 folds."""
    forest = RandomForestClassifier(seed=3, numTrees=20)
    choices = {forest.maxDepth: [3, 10], forest.featureSubsetStrategy: [str(n) for n in range(1, 11)], forest.minInstancesPerNode: (1, 10), forest.bootstrap: [True, False], forest.impurity: ["gini", "entropy"]}
    table, _best = tuning.search(vectors(t), "vec_id", forest, tuning.draw_candidates(choices, 20), accuracy(), 3)
    return table


@query("learning_curve")
def _(t):
    return tuning.learning_curve(vectors(t), "vec_id", NaiveBayes(modelType="gaussian"), accuracy(), [0.1, 0.325, 0.55, 0.775, 1.0], 3)


@query("validation_sweep")
def _(t):
    fits = {("l1_ratio", r): LogisticRegression(elasticNetParam=r, regParam=0.02, maxIter=20) for r in (0.25, 0.5, 0.75, 0.9)}
    return tuning.sweep(vectors(t, 2), "vec_id", fits, accuracy(), lambda m: (m.coefficients.toArray() != 0).sum())


@query("roc_curve", """
, long as (select class, score, positive from (select 'A' as class, l_quantity as score, l_returnflag = 'A' as positive from lineitem union all select 'N', l_linenumber + l_tax, l_returnflag = 'N' from lineitem
    union all select 'R', 50 - l_quantity, l_returnflag = 'R' from lineitem) y),
  everything as (select * from long union all select 'micro', score, positive from long),
  g as (select class, score::double as threshold, count(*) filter (where positive) as pos, count(*) filter (where not positive) as neg from everything group by 1, 2),
  c as (select *, sum(pos) over (partition by class order by threshold desc) as tps, sum(neg) over (partition by class order by threshold desc) as fps, sum(pos) over (partition by class) as p, sum(neg) over (partition by class) as n from g)
select class, threshold, round(fps / n, 6) as fpr, round(tps / p, 6) as tpr, round(sum(neg * (tps + tps - pos) / 2) over (partition by class) / (p::double * n), 6) as auc from c""")
def _(t):
    scores = {"A": F.col("l_quantity"), "N": F.col("l_linenumber") + F.col("l_tax"), "R": 50 - F.col("l_quantity")}
    long = e.one_vs_rest_scores(t.lineitem, "l_orderkey", "l_returnflag", scores)
    curve = e.roc_curve(long, ["class"], "score", "positive")
    return curve.select("class", "threshold", *[rounded(F.col(c), 6).alias(c) for c in ("fpr", "tpr", "auc")])


@query("roc_mean", """
, g as (select round as fold, distance::double as s, count(*) filter (where accept_status = 1) as pos, count(*) filter (where accept_status = 0) as neg from dispatch_detail group by 1, 2),
  c as (select fold, sum(pos) over w as tps, sum(neg) over w as fps, sum(pos) over (partition by fold) as p, sum(neg) over (partition by fold) as n from g window w as (partition by fold order by s desc)),
  pts as (select fold, fps, min(tps) as lo, max(tps) as hi, max(p) as p, max(n) as n from (select * from c union all select distinct fold, 0, 0, p, n from c) z group by 1, 2),
  seg as (select fold, fps as x0, hi as y0, lead(fps) over (partition by fold order by fps) as x1, lead(lo) over (partition by fold order by fps) as y1, p, n from pts),
  gp as (select fold, i, case when i = 99 then 1.0e0 else (y0 + (y1 - y0) / (x1 - x0)::double * (i / 99.0e0 * n - x0)) / p end as tpr from seg, range(0, 100) r(i)
    where (i < 99 and x0 * 99 <= i * n and i * n < x1 * 99) or (i = 99 and x1 is null))
select cast(i as int) as i, round(i / 99.0e0, 6) as fpr, round(case when i = 0 then 0 else avg(tpr) end, 6) as tpr from gp group by i""", "dispatch_detail")
def _(t):
    scored = t.dispatch_detail.select(F.col("round").alias("fold"), F.col("distance").cast("double").alias("s"), (F.col("accept_status") == 1).alias("hit"))
    return e.roc_mean(scored, "fold", "s", "hit").select("i", F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr"))


REPORT = f"""
, x as (select l_returnflag as y, {PREDICTED} as p from lineitem), cl as (select distinct y as class from x union select distinct p from x),
  m as (select class, (select count(*) from x where y = class) as support, (select count(*) from x where p = class) as called, (select count(*) from x where y = class and p = class) as hits from cl),
  r as (select class, coalesce(hits / nullif(called, 0), 0) as precision, coalesce(hits / nullif(support, 0), 0) as recall, support, coalesce(2.0e0 * hits / nullif(called + support, 0), 0) as f1 from m)
select class, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1, support from r
union all select 'avg / total', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), cast(sum(support) as bigint) from r"""


@query("class_report", REPORT)
def _(t):
    report = e.class_report(t.lineitem.withColumn("p", F.expr(PREDICTED)), "l_returnflag", "p")
    return report.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("confusion_matrix", f"""
select l_returnflag as actual, count(*) filter (where {PREDICTED} = 'A') as "A", count(*) filter (where {PREDICTED} = 'N') as "N", count(*) filter (where {PREDICTED} = 'R') as "R" from lineitem group by 1""")
def _(t):
    return e.confusion_matrix(t.lineitem.withColumn("p", F.expr(PREDICTED)), "l_returnflag", "p", ["A", "N", "R"])


@query("scalar_metrics", f"""
select round(avg(case when l_returnflag = {PREDICTED} then 1.0e0 else 0 end), 6) as accuracy, round(1 - avg(case when l_returnflag = {PREDICTED} then 1.0e0 else 0 end), 6) as hamming_loss,
  round(100 * avg(case when l_returnflag = {PREDICTED} then 1.0e0 else 0 end), 6) as classif_rate, round(avg(pow(l_extendedprice - l_quantity * 1500, 2)), 2) as mse,
  round(1 - sum(pow(l_extendedprice - l_quantity * 1500, 2)) / (var_pop(l_extendedprice) * count(*)), 6) as r2 from lineitem""")
def _(t):
    rows = t.lineitem.withColumn("p", F.expr(PREDICTED)).withColumn("guess", F.col("l_quantity") * 1500)
    both = e.classification_scores(rows, "l_returnflag", "p").first() + e.regression_scores(rows, "l_extendedprice", "guess").first()
    table = t.spark.createDataFrame([tuple(both)], "accuracy double, hamming_loss double, classif_rate double, mse double, r2 double")
    return table.select(*[F.round(c, 2 if c == "mse" else 6).alias(c) for c in table.columns])


@query("top_terms_per_class", r"""
, tok as (select doc_id, label, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) as term from labelled), tc as (select label, term, count(*) as n from tok group by 1, 2),
  voc as (select count(distinct term)::double as v from tok), sums as (select label, sum(n)::double as s from tc group by 1),
  ranked as (select label, term, round(ln((n + 0.01) / (s + 0.01 * v)), 6) as weight, row_number() over (partition by label order by n desc, term) as rank from tc join sums using (label), voc)
select label, term, weight, rank from ranked where rank <= 10""", "labelled")
def _(t):
    return text.top_terms(t.labelled, "doc_id", "label", text.words(F.col("text")), 10, 0.01).withColumn("weight", rounded(F.col("weight"), 6))


@query("cluster_scores", """
, t as (select l_returnflag as c, l_linenumber as k, count(*) as n from lineitem group by 1, 2), a as (select c, sum(n)::double as a from t group by 1), b as (select k, sum(n)::double as b from t group by 1),
  s as (select sum(n)::double as nn from t), h as (select (select -sum(a / nn * ln(a / nn)) from a, s) as hc, (select -sum(b / nn * ln(b / nn)) from b, s) as hk,
    (select sum(n / nn * ln(n * nn / (a * b))) from t join a using (c) join b using (k), s) as mi, (select sum(n * (n - 1) / 2.0e0) from t) as pr,
    (select sum(a * (a - 1) / 2) from a) as pc, (select sum(b * (b - 1) / 2) from b) as pk, (select nn * (nn - 1) / 2 from s) as pp,
    (select sum(x / nn * ln(nn * x / (a * b)) * exp(lgamma(a + 1) + lgamma(b + 1) + lgamma(nn - a + 1) + lgamma(nn - b + 1) - lgamma(nn + 1) - lgamma(x + 1) - lgamma(a - x + 1) - lgamma(b - x + 1) - lgamma(nn - a - b + x + 1)))
     from (select a, b, nn, unnest(generate_series(cast(greatest(1, a + b - nn) as bigint), cast(least(a, b) as bigint))) as x from a, b, s) z) as emi)
select round(mi / hc, 6) as homogeneity, round(mi / hk, 6) as completeness, round(2 * (mi / hc) * (mi / hk) / (mi / hc + mi / hk), 6) as v_measure,
  round((pr - pc * pk / pp) / ((pc + pk) / 2 - pc * pk / pp), 6) + 0.0 as ari, round((mi - emi) / (greatest(hc, hk) - emi), 6) + 0.0 as ami from h""")
def _(t):
    out = e.cluster_scores(t.lineitem, "l_returnflag", "l_linenumber")
    return out.select(*[rounded(F.col(c), 6).alias(c) for c in out.columns])


@query("silhouette", """
, d as (select a.vec_id, a.label, b.label as other, sum(pow(list_distance(a.embedding::double[], b.embedding::double[]), 2)) as s, count(*) as n from embeddings a, embeddings b where a.vec_id <> b.vec_id group by 1, 2, 3),
  v as (select vec_id, label, max(case when other = label then s / n end) as a, min(case when other <> label then s / n end) as b from d group by 1, 2)
select label, count(*) as n, round(avg((b - a) / greatest(a, b)), 6) as silhouette from v group by 1""")
def _(t):
    rows = e.silhouette_rows(t.embeddings, "vec_id", "embedding", "label")
    return rows.groupBy("label").agg(F.count("*").alias("n"), rounded(F.avg("silhouette"), 6).alias("silhouette"))


