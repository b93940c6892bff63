"""Benchmark items found inside documents by size-partitioned MinHash containment search.

An item of q word shingles is contained when at least `percent` of them are in the document,
however long it is. The items' sketch is their smallest hashes; items are partitioned into
size classes (powers of two), since the sketch must grow with the size: of q shingles
q - need + 1 are taken, need = ceil(percent q / 100), and as a document may lack only q - need
of them, it has at least one of the sketch. So the search misses nothing. A document sends
the hashes below the largest sketch value of the classes that fit into its size, not its
whole set, and candidates are verified on the full sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.texts import list_column, over_batches, raw_texts, shingle_set
from millrace.session import cut


def needed(size: int, percent: int) -> int:
    """The fewest shared shingles that reach the threshold."""
    return -(-percent * size // 100)


def item_sketches(items: DataFrame, id_col: str, text_col: str, shingle_words: int, percent: int) -> DataFrame:
    """(item_id, size_class, need, hashes, sketch, top) of the items that have a word."""

    def sketch(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(raw, shingle_words) for raw in raw_texts(batch.column(1))]
        keep = [i for i, s in enumerate(sets) if len(s)]
        sets = [sets[i] for i in keep]
        needs = [needed(len(s), percent) for s in sets]
        return pa.RecordBatch.from_arrays([
            batch.column(0).take(pa.array(keep, pa.int64())), pa.array([len(s).bit_length() for s in sets], pa.int32()), pa.array(needs, pa.int64()),
            list_column([s.view(np.int64) for s in sets], pa.int64()),
            list_column([s[: len(s) - n + 1].view(np.int64) for s, n in zip(sets, needs)], pa.int64()),
            pa.array([int(s[len(s) - n]) - 2**63 for s, n in zip(sets, needs)], pa.int64()),
        ], names=["item_id", "size_class", "need", "hashes", "sketch", "top"])

    named = items.select(F.col(id_col).cast("bigint").alias("item_id"), F.col(text_col).alias("text")).distinct()
    return over_batches(named, sketch, "item_id bigint, size_class int, need bigint, hashes array<bigint>, sketch array<bigint>, top bigint")


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                    shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, item_id, n_common, n_item): every document and item with 100 * common >= percent * item size.

    Null and empty texts contain nothing and are contained in nothing; a text shorter than a
    shingle is one shingle. Rows without an id are left out. Repeated rows count once; of rows
    that share an id the best is taken. Further columns are ignored.
    """
    sketches = cut(item_sketches(items, item_col, item_text_col, shingle_words, percent))
    # One row per power of two, at most 64. `top` is unsigned, moved into the signed range.
    classes = sketches.groupBy("size_class").agg(F.min("need").alias("need"), F.max("top").alias("top")).collect()
    limits = sorted((int(r["need"]), int(r["top"]) + 2**63) for r in classes)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")

    def send(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for raw in raw_texts(batch.column(1)):
            found = shingle_set(raw, shingle_words)
            below = max((top for need, top in limits if need <= len(found)), default=-1)
            out.append(found[: np.searchsorted(found, np.uint64(below), "right")].view(np.int64) if below >= 0 else np.empty(0, np.int64))
        return pa.RecordBatch.from_arrays([batch.column(0), list_column(out, pa.int64())], names=["doc_id", "sent"])

    sent = over_batches(rows, send, "doc_id bigint, sent array<bigint>").select("doc_id", F.explode("sent").alias("h"))
    entries = sketches.select("item_id", F.explode("sketch").alias("h"))
    candidates = cut(sent.join(entries, "h").select("doc_id", "item_id").distinct())
    pairs = rows.join(candidates, "doc_id").join(sketches.select("item_id", "need", "hashes"), "item_id")

    def verify(batch: pa.RecordBatch) -> pa.RecordBatch:
        last, found, common = None, None, []
        for raw, hashes in zip(raw_texts(batch.column(2)), batch.column(4)):
            if raw != last:
                last, found = raw, shingle_set(raw, shingle_words)
            common.append(len(np.intersect1d(found, hashes.values.to_numpy().view(np.uint64), assume_unique=True)))
        enough = [i for i, (c, need) in enumerate(zip(common, batch.column(3).to_pylist())) if c >= need]
        sizes = pa.array([len(h) for h in batch.column(4)], pa.int64())
        whole = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(common, pa.int64()), sizes], names=["doc_id", "item_id", "n_common", "n_item"])
        return whole.take(pa.array(enough, pa.int64()))

    found = over_batches(pairs.select("doc_id", "item_id", "text", "need", "hashes"), verify, "doc_id bigint, item_id bigint, n_common bigint, n_item bigint")
    return found.groupBy("doc_id", "item_id").agg(F.max_by(F.struct("n_common", "n_item"), F.col("n_common") / F.col("n_item")).alias("best")).select("doc_id", "item_id", "best.*")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per document id: n_items, item_ids (ascending), containment (the highest) and contaminated.

    Documents without a hit, null ids among them, have n_items 0, an empty list and 0.0.
    """
    hits = contained_items(docs, items, id_col=id_col, **options)
    per_doc = hits.groupBy("doc_id").agg(F.count("*").alias("n_items"), F.sort_array(F.collect_list("item_id")).alias("item_ids"), F.max(F.col("n_common") / F.col("n_item")).alias("containment"))
    ids = docs.select(F.col(id_col).cast("bigint").alias("doc_id")).distinct()
    out = ids.join(per_doc, "doc_id", "left")
    return out.select("doc_id", F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"), F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"),
                      F.coalesce("containment", F.lit(0.0)).alias("containment"), F.col("n_items").isNotNull().alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that contain no item, with all their columns; rows without an id stay."""
    bad = contained_items(docs, items, **options).select(F.col("doc_id").alias("_bad_id")).distinct()
    return docs.join(bad, docs["doc_id"] == F.col("_bad_id"), "left_anti")
