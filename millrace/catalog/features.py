"""Feature transforms."""

from pyspark.sql import functions as F

from millrace.catalog import query
from millrace.functions.scalars import number_tokens, rounded
from millrace.operators import features as f
from millrace.operators import text

# fixed values: part types of the given tables
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
STOP = ["the", "of", "and", "to", "in", "that", "is", "it", "for", "with"]
LONG = ", lv as (select vec_id, label, i - 1 as pos, embedding[i]::double as v from embeddings, range(1, 65) r(i))"


@query("label_encode", "select id, p_brand, cast(dense_rank() over (order by p_brand) - 1 as int) as brand_val, cast(dense_rank() over (order by p_type) - 1 as int) as type_val from features_wide", "features_wide")
def _(t):
    return f.label_encode(f.label_encode(t.features_wide.select("id", "p_brand", "p_type"), "p_brand", "brand_val"), "p_type", "type_val").drop("p_type")


@query("one_hot", "select id, " + ", ".join(f"case when p_type = '{v}' then 1 else 0 end as p_type_{v}" for v in TYPES) + " from features_wide", "features_wide")
def _(t):
    return f.one_hot(t.features_wide.select("id", "p_type"), "p_type", TYPES).drop("p_type")


@query("impute_mean", "select l_orderkey, l_linenumber, l_partkey, l_suppkey, round(case when l_tax = 0 then (select avg(l_tax) from lineitem where l_tax <> 0) else l_tax end, 6) as tax from lineitem")
def _(t):
    filled = f.impute_mean(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_tax").alias("tax")), ["tax"], missing=0)
    return filled.withColumn("tax", rounded(F.col("tax"), 6))


@query("impute_constant", "select c_custkey, coalesce(district, (select district from addresses where district is not null group by 1 order by count(*) desc, 1 limit 1)) as district from addresses", "addresses")
def _(t):
    return f.impute_most_frequent(t.addresses.select("c_custkey", "district"), "district")


@query("standardise", """
select id, round((p_size - avg(p_size) over ()) / stddev_pop(p_size) over (), 6) + 0.0 as p_size, round((p_retailprice - avg(p_retailprice) over ()) / stddev_pop(p_retailprice) over (), 6) + 0.0 as p_retailprice from features_wide""", "features_wide")
def _(t):
    out = f.standardise(t.features_wide.select("id", "p_size", "p_retailprice"), ["p_size", "p_retailprice"])
    return out.withColumns({c: rounded(F.col(c), 6) for c in ("p_size", "p_retailprice")})


@query("minmax_eps", """
select id, round((p_size - min(p_size) over ()) / (max(p_size) over () + 0.0001), 6) as p_size, round((p_retailprice - min(p_retailprice) over ()) / (max(p_retailprice) over () + 0.0001), 6) as p_retailprice from features_wide""", "features_wide")
def _(t):
    out = f.minmax_eps(t.features_wide.select("id", "p_size", "p_retailprice"), ["p_size", "p_retailprice"])
    return out.withColumns({c: rounded(F.col(c), 6) for c in ("p_size", "p_retailprice")})


@query("double_center", LONG + """, c as (select *, v - avg(v) over (partition by pos) as w from lv)
select vec_id, cast(pos as int) as pos, round(w - avg(w) over (partition by vec_id), 6) + 0.0 as value from c""")
def _(t):
    return f.long_form(f.double_center(t.embeddings, "embedding"), "vec_id", "embedding").withColumn("value", rounded(F.col("value"), 6))


@query("l2_normalise", LONG + """ select vec_id, cast(pos as int) as pos, round(v / sqrt(sum(v * v) over (partition by vec_id)), 6) + 0.0 as value from lv""")
def _(t):
    return f.long_form(f.l2_normalise(t.embeddings, "embedding"), "vec_id", "embedding").withColumn("value", rounded(F.col("value"), 6))


@query("polynomial", """
select id, 1.0::double as bias, round(a, 12) as a, round(b, 12) as b, round(a * a, 12) as "a*a", round(a * b, 12) as "a*b", round(b * b, 12) as "b*b", round(a * a * a, 12) as "a*a*a", round(a * a * b, 12) as "a*a*b",
  round(a * b * b, 12) as "a*b*b", round(b * b * b, 12) as "b*b*b" from (select id, p_size / 10.0e0 as a, p_retailprice / 1000 as b from features_wide) x""", "features_wide")
def _(t):
    rows = t.features_wide.select("id", (F.col("p_size") / 10).alias("a"), (F.col("p_retailprice") / 1000).alias("b"))
    out = f.polynomial(rows, ["a", "b"], 3, bias=True)
    return out.select("id", "bias", *[rounded(F.col(f"`{c}`"), 12).alias(c) for c in out.columns if c not in ("id", "bias")])


@query("column_select", LONG + " select vec_id, cast(pos - 1 as int) as pos, v as value from lv where pos >= 1")
def _(t):
    kept = f.column_slice(t.embeddings, "embedding", 1, 63)
    return f.long_form(kept, "vec_id", "embedding").withColumn("value", F.col("value").cast("double"))


@query("feature_union", """
, x as (select doc_id, length(text) as a, length(text) - length(replace(text, '.', '')) as b, strlen(text) as c, case when lang = 'en' then 1 else 0 end as d from documents),
  u as (select doc_id, 0 as pos, a * 0.8::double as value from x union all select doc_id, 1, b * 0.8::double from x union all select doc_id, 2, c * 0.5::double from x union all select doc_id, 3, d::double from x)
select doc_id, pos, round(value, 6) as value from u""")
def _(t):
    body = F.col("text")
    joined = f.feature_union(t.documents, {
        "stats": ([F.length(body), F.regexp_count(body, F.lit(r"\."))], 0.8), "size": ([F.octet_length(body)], 0.5), "lang": ([(F.col("lang") == "en").cast("int")], 1.0)}, "v")
    return f.long_form(joined, "doc_id", "v").withColumn("value", F.round("value", 6))


@query("dict_features", """
, x as (select id, coalesce(age, 0) as a, name_len, p_retailprice, p_size from features_wide)
select id, 0 as pos, a::double as value from x union all select id, 1, name_len::double from x union all select id, 2, p_retailprice from x union all select id, 3, p_size::double from x""", "features_wide")
def _(t):
    records = t.features_wide.select("id", F.struct("p_size", "p_retailprice", "age", "name_len").alias("record"))
    return f.long_form(f.dict_features(records, "record", "v"), "id", "v")


def _stop(column):
    return f"list_filter({column}, lambda w: w not in ({', '.join(repr(w) for w in STOP)}))"


TOKENS = ", tok as (select doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}') as w from documents)"
COUNTS = TOKENS + ", cnt as (select doc_id, term, count(*) as n from (select doc_id, unnest(w) as term from tok) group by 1, 2), fr as (select term, count(*) as df from cnt group by 1)"


@query("count_vectors", TOKENS + f""", clean as (select doc_id, {_stop('w')} as w from tok),
  grams as (select doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) as term from clean),
  cnt as (select doc_id, term, count(*) as n from grams group by 1, 2),
  voc as (select term from cnt group by 1 having count(*) >= 2 and count(*) <= 0.95 * (select count(*) from documents) order by sum(n) desc, term limit 1000)
select doc_id, term, n from cnt where term in (select term from voc)""")
def _(t):
    tokens = text.with_pairs(text.without(text.words(F.col("text")), STOP))
    return text.top_counts(t.documents, "doc_id", tokens, t.documents.count(), min_df=2, max_df=0.95, max_features=1000).select("doc_id", "term", "n")


@query("tfidf", COUNTS + """, wt as (select doc_id, term, n * (ln((1.0e0 + (select count(*) from documents)) / (1 + df)) + 1) as w from cnt join fr using (term))
select doc_id, term, round(w / sqrt(sum(w * w) over (partition by doc_id)), 6) as weight from wt""")
def _(t):
    counts = text.term_counts(t.documents, "doc_id", text.words(F.col("text")))
    return text.tfidf(counts, "doc_id", t.documents.count()).withColumn("weight", F.round("weight", 6))


@query("hash_vectors")
def _(t):
    return text.hashed_counts(t.documents, "doc_id", text.words(F.col("text")), 1 << 16)


@query("number_tokens", """
, tok as (select doc_id, list_transform(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}'), lambda w: case when regexp_matches(w, '^[0-9_]') then '#NUMBER' else w end) as w from documents)
select doc_id, term, count(*) as n from (select doc_id, unnest(w) as term from tok) group by 1, 2""")
def _(t):
    return text.term_counts(t.documents, "doc_id", number_tokens(F.col("text")))


@query("random_fourier")
def _(t):
    return f.random_fourier(t.embeddings, "embedding", 64, 100, 0.2, 1, "features").select("vec_id", "label", "features")


@query("nystroem")
def _(t):
    return f.nystroem(t.embeddings, "vec_id", "embedding", 60, 0.2, "features").select("vec_id", "label", "features")


@query("chi2_kernel", """
, x as (select id, p_brand, p_size::double as a, p_retailprice / 100 as b, name_len::double as c from features_wide), m as (select p_brand, avg(a) as ma, avg(b) as mb, avg(c) as mc from x group by 1)
select id, m.p_brand as landmark, round(exp(-0.5 * ((a - ma) * (a - ma) / (a + ma) + (b - mb) * (b - mb) / (b + mb) + (c - mc) * (c - mc) / (c + mc))), 6) as k from x, m""", "features_wide")
def _(t):
    rows = t.features_wide.select("id", "p_brand", F.array(F.col("p_size").cast("double"), F.col("p_retailprice") / 100, F.col("name_len").cast("double")).alias("v"))
    marks = rows.groupBy("p_brand").agg(F.array(*[F.avg(F.col("v")[i]) for i in range(3)]).alias("v"))
    landmarks = [(r[0], r[1]) for r in f.bounded_collect(marks.orderBy("p_brand"), 1000, "landmarks")]
    return rows.select("id", F.inline(f.chi2_kernel(F.col("v"), landmarks, 0.5)).alias("landmark", "k")).withColumn("k", rounded(F.col("k"), 6))


_U = "(cast('0x' || substr(md5('5:{0}:' || cast(vec_id as varchar)), 1, 15) as bigint) / 1152921504606846976.0e0)"


@query("noise_columns", "select vec_id, " + ", ".join(
    f"round(sqrt(-2 * ln(1 - {_U.format(2 * i)})) * cos({_U.format(2 * i + 1)} * 2 * pi()), 6) + 0.0 as noise_{i}" for i in range(3)) + " from embeddings")
def _(t):
    out = f.noise_columns(t.embeddings.select("vec_id"), "vec_id", 3, seed=5)
    return out.select("vec_id", *[rounded(F.col(f"noise_{i}"), 6).alias(f"noise_{i}") for i in range(3)])
