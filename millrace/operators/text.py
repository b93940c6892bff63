"""Term counts and weights in long form (doc, term, value), which has no vocabulary limit."""

from __future__ import annotations

from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import cut, drop_cut

WORD = r"[\p{L}\p{N}_]{2,}"


def words(text: Column) -> Column:
    """Lower-cased runs of two or more letters, digits or underscores."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def without(tokens: Column, stop: list[str]) -> Column:
    return F.filter(tokens, lambda w: ~w.isin(stop)) if stop else tokens


def with_pairs(tokens: Column) -> Column:
    """Single words followed by all neighbouring pairs."""
    pairs = F.zip_with(tokens, F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, F.coalesce(b, F.lit("\0"))))
    return F.concat(tokens, F.slice(pairs, F.lit(1), F.greatest(F.size(tokens) - 1, F.lit(0))))


def term_counts(docs: DataFrame, key: str, tokens: Column, terms: DataFrame | None = None) -> DataFrame:
    """(key, term, n), of all terms or of those in `terms` only."""
    exploded = docs.select(key, F.explode(tokens).alias("term"))
    if terms is not None:
        exploded = exploded.join(terms, "term", "left_semi").select(key, "term")
    return exploded.groupBy(key, "term").agg(F.count("*").alias("n"))


def document_frequency(counts: DataFrame) -> DataFrame:
    return counts.groupBy("term").agg(F.count("*").alias("df"), F.sum("n").alias("total"))


def limit_vocabulary(counts: DataFrame, documents: int, min_df: int = 1, max_df: float = 1.0, max_features: int | None = None) -> DataFrame:
    """Keep terms by document frequency, then the most frequent ones overall.

    The counts are written once, so the texts are not split again for the second use.
    """
    counts = cut(counts)
    vocabulary = document_frequency(counts).where((F.col("df") >= min_df) & (F.col("df") <= max_df * documents))
    if max_features is not None:
        vocabulary = vocabulary.orderBy(F.desc("total"), "term").limit(max_features)
    return counts.join(vocabulary.select("term"), "term", "left_semi")


def top_counts(docs: DataFrame, key: str, tokens: Column, documents: int, min_df: int, max_df: float, max_features: int) -> DataFrame:
    """limit_vocabulary of all terms' counts, without counting all terms per document.

    Totals per term need no documents and shrink before they are shuffled. Only terms that lead
    by their total are counted per document: as many as max_features need, more as long as
    document frequencies leave too few of them. The texts are split once.
    """
    docs = cut(docs.select(key, tokens.alias("tokens")))
    tokens = F.col("tokens")
    totals = cut(docs.select(F.explode(tokens).alias("term")).groupBy("term").agg(F.count("*").alias("total")))
    size, leaders = totals.count(), 2 * max_features
    while True:
        leading = totals.orderBy(F.desc("total"), "term").limit(leaders).select("term")
        counts = cut(term_counts(docs, key, tokens, leading))
        frequency = document_frequency(counts)
        if leaders >= size or frequency.where((F.col("df") >= min_df) & (F.col("df") <= max_df * documents)).count() >= max_features:
            kept = cut(limit_vocabulary(counts, documents, min_df, max_df, max_features))
            drop_cut(docs, totals, counts)
            return kept
        drop_cut(counts)
        leaders *= 8


def largest_df(docs: DataFrame, share: float) -> float:
    """A share of documents as CountVectorizer's maxDF in documents: given a share, it keeps all tokens to count rows."""
    most = share * docs.count()
    return most if most >= 1 else share


def tfidf(counts: DataFrame, key: str, documents: int, sublinear: bool = False, spent: bool = False) -> DataFrame:
    """tf * (ln((1+n)/(1+df)) + 1), scaled to unit length per document. With `spent`, cuts that the counts come from are deleted."""
    tf = F.log("n") + 1 if sublinear else F.col("n").cast("double")
    given, counts = counts, cut(counts)  # used four times below; the texts are read once
    if spent:
        drop_cut(given)
    frequencies = document_frequency(counts).select("term", "df")
    weighted = counts.join(frequencies, "term").select(key, "term", (tf * (F.log((1.0 + documents) / (1 + F.col("df"))) + 1)).alias("w"))
    norms = weighted.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return weighted.join(norms, key).select(key, "term", (F.col("w") / F.col("norm")).alias("weight"))


def hashed_counts(docs: DataFrame, key: str, tokens: Column, buckets: int) -> DataFrame:
    """(key, bucket, n): hashed term counts in long form."""
    exploded = docs.select(key, F.explode(tokens).alias("w"))
    return exploded.groupBy(key, F.pmod(F.xxhash64("w"), F.lit(buckets)).alias("bucket")).agg(F.count("*").alias("n"))


def hashed(docs: DataFrame, tokens: Column, buckets: int, name: str = "features") -> DataFrame:
    """Sparse term counts in a fixed number of buckets; needs no pass to fit."""
    return HashingTF(numFeatures=buckets, inputCol="_tokens", outputCol=name).transform(docs.withColumn("_tokens", tokens)).drop("_tokens")


def top_terms(docs: DataFrame, key: str, label: str, tokens: Column, k: int, alpha: float) -> DataFrame:
    """(label, term, weight, rank): the k terms of highest smoothed log-probability per class, ties by term.

    Counts stay in long form over the whole vocabulary; a rank limit is applied before the
    last shuffle. A class with fewer than k terms of its own has only these.
    """
    counts = cut(docs.select(label, F.explode(tokens).alias("term")).groupBy(label, "term").agg(F.count("*").alias("n")))
    size = counts.select(F.countDistinct("term")).first()[0]
    sums = counts.groupBy(label).agg(F.sum("n").alias("s"))
    best = Window.partitionBy(label).orderBy(F.desc("n"), "term")
    own = counts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    weight = F.log((F.col("n") + alpha) / (F.col("s") + alpha * size))
    return own.join(sums, label).select(label, "term", weight.alias("weight"), F.col("rank").cast("bigint").alias("rank"))
