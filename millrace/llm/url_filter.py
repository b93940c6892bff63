"""URL verdicts: longest rule first, otherwise naive Bayes on segmented host and path words.

Hosts are written without spaces, so their letters are split into words: the split of the
highest unigram probability (Viterbi), counts taken from the pages' own text. A multinomial
naive Bayes model is trained on the pages that a rule decides and judges the others. Word
counts, training and scoring are joins and sums over distinct hosts and distinct (host, path
words) pairs, so copies of a host cost one row.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.texts import over_batches
from millrace.session import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LONGEST = 24  # letters of the longest word that is looked up
MOST_RULES = 1000
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def ruled(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, ties to the first in text order; null if none fits."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules; join them as a table")
    tests = []
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, slash, start = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        tests.append(F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*tests) if tests else F.lit(None).cast("struct<rule:string,verdict:string>")


def word_counts(pages: DataFrame, html_col: str) -> DataFrame:
    """(word, n) over the text outside tags, runs of a-z in lower case."""
    plain = F.lower(F.regexp_replace(F.coalesce(F.col(html_col), F.lit("")), r"<[^>]*>", " "))
    rows = pages.select(F.explode(F.split(plain, "[^a-z]+")).alias("word"))
    return rows.where(F.length("word").between(1, LONGEST)).groupBy("word").agg(F.count("*").alias("n"))


def best_split(run: str, costs: dict[str, float], total: float) -> list[str]:
    """The most probable words of a run of letters.

    An unknown word of k letters has the probability 10 / (total * 10^k), so a run without
    known words stays whole as far as LONGEST allows. Of equal splits the one whose last word
    is longest wins.
    """
    best, back = [0.0] + [math.inf] * len(run), [0] * (len(run) + 1)
    for end in range(1, len(run) + 1):
        for start in range(max(0, end - LONGEST), end):
            piece = run[start:end]
            cost = best[start] + costs.get(piece, math.log(total) + (len(piece) - 1) * math.log(10))
            if cost < best[end] - 1e-9:
                best[end], back[end] = cost, start
    out, at = [], len(run)
    while at:
        out.append(run[back[at] : at])
        at = back[at]
    return out[::-1]


def segmented(runs: DataFrame, counts: DataFrame) -> DataFrame:
    """(run, words) for distinct runs of letters; each run gets the counts of its own pieces only."""
    counts = cut(counts)
    total = float(counts.agg(F.sum("n")).first()[0] or 0) + 1.0
    length = F.length("run")
    starts = runs.select("run", F.explode(F.sequence(F.lit(1), length)).alias("at"))
    pieces = starts.select("run", F.explode(F.transform(F.sequence(F.lit(1), F.least(F.lit(LONGEST), length - F.col("at") + 1)),
                                                         lambda k: F.substring("run", F.col("at"), k))).alias("word")).distinct()
    known = pieces.join(counts, "word").groupBy("run").agg(F.collect_list(F.struct("word", "n")).alias("known"))

    def split(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [best_split(run, {k["word"]: math.log(total) - math.log(k["n"]) for k in known or ()}, total)
               for run, known in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.string()))], names=["run", "words"])

    return over_batches(runs.join(known, "run", "left").select("run", "known"), split, "run string, words array<string>")


def host_words(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """(host, host_words) for distinct hosts: the words of each run of letters, in order."""
    placed = hosts.select("host", F.posexplode(F.split("host", "[^a-z]+")).alias("at", "run")).where("run <> ''")
    split = segmented(placed.select("run").distinct(), counts)
    parts = placed.join(split, "run").groupBy("host").agg(F.array_sort(F.collect_list(F.struct("at", "words"))).alias("parts"))
    return parts.select("host", F.flatten(F.transform("parts", lambda p: p["words"])).alias("host_words"))


def path_words(path: Column) -> Column:
    """Runs of letters and digits in lower case; a run with a digit counts by its shape only."""
    runs = F.filter(F.split(F.lower(path), "[^a-z0-9]+"), lambda w: w != "")
    return F.transform(runs, lambda w: F.when(w.rlike("[0-9]"), F.lit("#")).otherwise(w))


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]] | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", smoothing: float = 1.0) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) per row.

    A null url or one without "://" has an empty host and path, fits no rule and is judged by
    the prior. The score is log P(block) - log P(allow) of the words known from training;
    positive means block, a tie allow. Without any page that a rule decides all are allowed.
    Rows repeated whole are judged each; an empty table gives no rows; further columns are
    ignored. Hosts and paths of any length are taken whole.
    """
    rules = RULES if rules is None else rules
    base = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    base = base.withColumn("fit", ruled(F.col("host"), F.col("path"), rules)).withColumn("path_words", path_words(F.col("path")))
    judged = cut(base.select("page_id", "host", "path", "path_words", F.col("fit.rule").alias("rule"), F.col("fit.verdict").alias("given")))
    kinds = cut(judged.groupBy("host", "path_words").agg(F.count_if(F.col("given") == "block").alias("block"), F.count_if(F.col("given") == "allow").alias("allow")))
    split = host_words(kinds.select("host").distinct(), word_counts(pages, html_col))
    sides = F.concat(F.transform(F.coalesce("host_words", F.array().cast("array<string>")), lambda w: F.concat(F.lit("h:"), w)),
                     F.transform("path_words", lambda w: F.concat(F.lit("p:"), w)))
    kinds = kinds.join(split, "host", "left")
    tokens = cut(kinds.select("host", "path_words", "block", "allow", F.explode(sides).alias("token")).groupBy("host", "path_words", "token", "block", "allow").agg(F.count("*").alias("times")))
    seen = cut(tokens.groupBy("token").agg(F.sum(F.col("times") * F.col("block")).alias("block"), F.sum(F.col("times") * F.col("allow")).alias("allow")).where("block + allow > 0"))
    sums = seen.agg(F.sum("block").alias("block"), F.sum("allow").alias("allow"), F.count("*").alias("n")).first()
    docs = kinds.agg(F.sum("block").alias("block"), F.sum("allow").alias("allow")).first()
    lost = math.log(((sums["allow"] or 0) + smoothing * max(sums["n"], 1)) / ((sums["block"] or 0) + smoothing * max(sums["n"], 1)))
    weights = seen.select("token", (F.log(F.col("block") + smoothing) - F.log(F.col("allow") + smoothing) + lost).alias("weight"))
    prior = math.log((docs["block"] or 0) + smoothing) - math.log((docs["allow"] or 0) + smoothing)
    scores = tokens.join(weights, "token").groupBy("host", "path_words").agg(F.sum(F.col("times") * F.col("weight")).alias("sum"))
    scores = scores.select(F.col("host").alias("_host"), F.col("path_words").alias("_words"), "sum")
    out = judged.join(scores, (F.col("host") == F.col("_host")) & (F.col("path_words") == F.col("_words")), "left")
    score = F.round(F.coalesce("sum", F.lit(0.0)) + F.lit(prior), 9)
    return out.select("page_id", "host", "path", "rule", F.coalesce("given", F.when(score > 0, "block").otherwise("allow")).alias("verdict"), score.alias("score"))
