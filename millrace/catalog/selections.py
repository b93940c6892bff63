"""Feature selection."""

from pyspark.sql import functions as F

from millrace.catalog import query
from millrace.functions.scalars import rounded
from millrace.operators import selection as sel
from millrace.operators.features import to_vector

COLUMNS = ["p_size", "p_retailprice", "age0", "name_len", "brand_no"]
PREP = """, x as (select id, label, p_size, p_retailprice, coalesce(age, 0) as age0, name_len, cast(substr(p_brand, 7) as int) as brand_no from features_wide)"""
UNION = ", l as (" + " union all ".join(f"select '{c}' as name, {c}::double as v, label from x" for c in COLUMNS) + ")"


def _prepared(t):
    return t.features_wide.select("id", "label", "p_size", "p_retailprice", F.coalesce("age", F.lit(0.0)).alias("age0"), "name_len",
                                  F.substring(F.col("p_brand"), 7, 9).cast("int").alias("brand_no"))


@query("chi2_rank", PREP + UNION + """, c as (select name, label, sum(v) as s, count(*) as n from l group by 1, 2), a as (select name, sum(s) as alls, sum(n) as alln, count(*) - 1 as dof from c group by 1)
select c.name, round(sum(pow(s - alls * n / alln, 2) / (alls * n / alln)), 4) as chi2, max(dof) as dof from c join a on a.name = c.name group by 1""", "features_wide")
def _(t):
    return sel.chi2_rank(_prepared(t), COLUMNS, "label").select("name", rounded(F.col("chi2"), 4).alias("chi2"), "dof")


@query("pearson_rank", PREP + UNION + " select name, round(corr(v, label), 6) + 0.0 as pearsonr from l group by 1", "features_wide")
def _(t):
    return sel.pearson_rank(_prepared(t), COLUMNS, "label").select("name", rounded(F.col("pearsonr"), 6).alias("pearsonr"))


@query("mutual_info_rank", PREP + UNION + """, e as (select name, min(v) as lo, max(v) as hi from l group by 1),
  b as (select l.name, label, case when hi > lo then least(floor((v - lo) / ((hi - lo) / 10)), 9) else 0 end as bin from l join e on e.name = l.name),
  j as (select name, bin, label, count(*) as n from b group by 1, 2, 3),
  t as (select name, n, sum(n) over (partition by name, bin) as nb, sum(n) over (partition by name, label) as nc, sum(n) over (partition by name) as nn from j)
select name, round(sum(n / nn * ln((n * nn) / (nb * nc))), 6) + 0.0 as mutual_information from t group by 1""", "features_wide")
def _(t):
    return sel.mutual_info_rank(_prepared(t), COLUMNS, "label").withColumn("mutual_information", rounded(F.col("mutual_information"), 6))


@query("tree_rank")
def _(t):
    return sel.tree_rank(_prepared(t), COLUMNS, "label").select("name", "importance")


@query("forest_importance_spread")
def _(t):
    return sel.tree_rank(_prepared(t), COLUMNS, "label", trees=25, seed=1)


@query("anova_f", PREP + UNION + """, c as (select name, label, sum(v) as s, sum(v * v) as q, count(*) as n from l group by 1, 2),
  a as (select name, sum(n) as n, count(*) as k, sum(s) as s, sum(q) as q, sum(s * s / n) as b from c group by 1)
select name, round(((b - s * s / n) / (k - 1)) / ((q - b) / (n - k)), 4) + 0.0 as f from a""", "features_wide")
def _(t):
    return sel.anova_f(_prepared(t), COLUMNS, "label").select("name", rounded(F.col("f"), 4).alias("f"))


@query("variance_filter", PREP + UNION + " select name, round(var_pop(v), 6) as variance, var_pop(v) > 30 as kept from l group by 1", "features_wide")
def _(t):
    return sel.variances(_prepared(t), COLUMNS, 30.0).withColumn("variance", rounded(F.col("variance"), 6))


@query("lasso_select")
def _(t):
    kept, threshold = sel.lasso_select(_prepared(t), ["p_size", "age0", "name_len", "brand_no"], "p_retailprice")
    return t.spark.createDataFrame([(threshold, ",".join(kept))], "threshold double, kept string")


@query("l1_svc_select")
def _(t):
    data = to_vector(t.embeddings.select("vec_id", "embedding", (F.col("label") < 5).cast("double").alias("label")), "embedding").select("vec_id", "features", "label")
    from millrace.operators.sampling import split_by_hash

    marked = split_by_hash(data, "vec_id", 0.7)
    _, scored = sel.l1_select_then_svc(marked.where("part = 'train'"), marked.where("part = 'test'"))
    return scored.select("vec_id", "label", "prediction")


@query("rfe_cv")
def _(t):
    return sel.eliminate_features(_prepared(t), COLUMNS, "label")
