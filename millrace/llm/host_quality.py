"""Quality rules per document and per host, in DataFrame functions only.

Each document is measured in one pass. Rule failures are added up per host, the host's
failure rates are shrunk towards the overall rate with a beta prior estimated from all hosts,
and hosts whose shrunk rate is too high are rejected with all their documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.texts import BLANKS, words
from millrace.session import cut

# Failures of a document that count against its host.
RULES = {
    "base": "base_failed",
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "10 * n_dup_lines > 3 * n_lines",
    "word_length": "word_chars < 2 * n_words or word_chars > 12 * n_words",
}


def _count_not(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, "")).cast("bigint")


def _covered(positions: Column, width: int) -> Column:
    """How many places the windows of this width at the sorted positions cover."""
    start = F.struct(F.lit(-width).alias("last"), F.lit(0).cast("bigint").alias("sum"))
    step = lambda a, x: F.struct(x.alias("last"), (a["sum"] + F.least(F.lit(width), x - a["last"])).alias("sum"))
    return F.aggregate(positions, start, step, lambda a: a["sum"])


def measures(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """(doc_id, host, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed).

    Windows of three words are compared by a 64-bit hash, sorted within the document.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), F.col(text_col).alias("text"))
    parts = base.select(
        "doc_id", "host", words(F.col("text")).alias("words"), _count_not(text, BLANKS).alias("word_chars"), _count_not(text, r"[^#*$%&|<>]+").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    after = lambda i, k: F.col("words")[i + k]
    windows = F.transform(F.slice("words", 1, F.greatest(F.size("words") - 2, F.lit(0))),
                          lambda w, i: F.struct(F.xxhash64(w, after(i, 1), after(i, 2)).alias("h"), i.alias("at")))
    sizes = [F.size("words").cast("bigint").alias("n_words"), F.size("lines").cast("bigint").alias("n_lines"),
             (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines")]
    ranked = parts.select("doc_id", "host", "word_chars", "n_symbols", *sizes, F.sort_array(windows).alias("w"))
    same = lambda g, i: F.coalesce(F.get("w", i)["h"] == g["h"], F.lit(False))
    twice = F.filter("w", lambda g, i: same(g, i - 1) | same(g, i + 1))
    found = ranked.withColumn("at", F.sort_array(F.transform(twice, lambda g: g["at"]))).drop("w")
    counted = found.withColumn("n_repeat_words", _covered(F.col("at"), 3)).drop("at")
    return counted.withColumn("base_failed", F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words"))


def host_rates(measured: DataFrame, rules: dict[str, str] | None = None) -> DataFrame:
    """(host, n, rate_<rule>...) with failure rates shrunk by a beta prior fitted to all hosts.

    The prior has the overall rate m as its mean. Its weight s follows from the spread of the
    hosts' rates beyond what chance gives (analysis of variance): with r the correlation of
    two documents of one host, s = (1 - r) / r, and the shrunk rate is (f + s m) / (n + s).
    Where hosts differ no more than by chance, every host gets the overall rate.
    """
    rules = rules or RULES
    hosts = cut(measured.where("host is not null").groupBy("host").agg(
        F.count("*").alias("n"), *[F.count_if(F.expr(r)).alias(f"f_{k}") for k, r in rules.items()]))
    n, f = F.col("n").cast("double"), lambda k: F.col(f"f_{k}").cast("double")
    total = hosts.agg(F.count("*").alias("hosts"), F.sum("n").alias("docs"), F.sum(n * n).alias("squares"),
                      *[F.sum(f(k)).alias(f"f_{k}") for k in rules], *[F.sum(f(k) * f(k) / n).alias(f"q_{k}") for k in rules]).first()
    rates = []
    for k in rules:
        docs, free = total["docs"] or 0, total["hosts"] - 1
        mean = (total[f"f_{k}"] or 0.0) / docs if docs else 0.0
        noise, spare = mean * (1 - mean), docs - total["squares"] / docs - free if docs else 0.0
        r = (total[f"q_{k}"] - docs * mean * mean - free * noise) / (noise * spare) if noise > 0 and spare > 0 else 0.0
        if r <= 0:
            rates.append(F.lit(mean).alias(f"rate_{k}"))
        else:
            s = (1 - min(r, 1.0)) / min(r, 1.0)
            rates.append(((f(k) + s * mean) / (n + s)).alias(f"rate_{k}"))
    return hosts.select("host", "n", *rates)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", limit: float = 0.5, rules: dict[str, str] | None = None) -> DataFrame:
    """One row per document: its measures, base_failed, host, host_failed and kept.

    A document is kept if it passes the base rules and no shrunk failure rate of its host is
    above `limit`. A null text has no words and fails; a document without a host is judged by
    itself; repeated rows are judged each; an empty table gives no rows. Other columns are
    ignored. Hot hosts are pre-aggregated, and the join back meets one row per host.
    """
    rules = rules or RULES
    measured = cut(measures(docs, id_col, text_col, host_col))
    over = [F.col(f"rate_{k}") > limit for k in rules]
    bad = over[0]
    for other in over[1:]:
        bad = bad | other
    verdicts = host_rates(measured, rules).select(F.col("host").alias("_host"), bad.alias("host_failed"))
    out = measured.join(verdicts, F.col("host") == F.col("_host"), "left").drop("_host")
    out = out.withColumn("host_failed", F.coalesce("host_failed", F.lit(False)))
    return out.withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed"))


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The documents that judge keeps, with all their columns; a repeated row stays as often as it was."""
    kept = judge(docs, **options).where("kept").select(F.col("doc_id").alias("_kept_id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(F.col("_kept_id")), "left_semi")
