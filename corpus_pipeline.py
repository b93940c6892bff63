"""Training-data pipeline over `documents`: each stage works on what the one before it kept.

Quality rules drop documents, near-duplicate detection leaves one of each group, repeated
passages are cut out of the texts, documents that hold benchmark items go, and the rest is
encoded into sampled segmentations. The first four stages return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import containment, host_quality, near_dedup, repeats
from millrace.llm.queries import sampled_digest
from millrace.session import cut, prepare
from millrace.sources.fixtures import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no rule of their own and whose host is not judged bad; null and empty texts have too few words and go, of rows that share an id all stay where one passes; an empty table stays empty."""
    prepare(spark)
    return host_quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies (5 words, 80 of 100); rows without an id, and texts without words, have no copies and stay; of rows that share an id the smallest text stays."""
    prepare(spark)
    return near_dedup.keep_one_of_each(docs, shingle_words=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-byte passages that a document of a smaller id holds too; no document goes, null texts stay null, other columns stay as they are."""
    prepare(spark)
    return repeats.without_repeats(docs, span=50)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item (80 of 100 of its 5-word shingles); null and empty texts hold none and stay."""
    return containment.drop_contaminated(docs, table(prepare(spark), sf_dir, "benchmark"), shingle_words=5, percent=80)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Three sampled segmentations per document, as sizes, checksums and scores; a null or empty text has one without pieces."""
    prepare(spark)
    return sampled_digest(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages),
          ("decontaminate", decontaminate), ("encode", encode)]

# Near-duplicate components, byte cuts and seeded samples have no SQL form; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a data folder; each result is written and read again."""
    docs = table(prepare(spark), sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
