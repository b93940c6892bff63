"""Tokens of whole documents attributed to sections by their character offsets.

Each document is encoded once as a whole, so no boundary of a section changes a token. The
tokens' character spans are joined to the sections' intervals; both are sorted, so the join
is a search in the document's own token positions, also where sections overlap.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.byte_bpe import WholeTexts
from millrace.llm.texts import over_batches

RULES = ("first", "most", "share")
SECTIONS = "array<struct<section:bigint,start:bigint,end:bigint>>"


def line_spans(text: str | None) -> np.ndarray:
    """(start, end) of the lines of a text, without their line ends; a null or empty text has none."""
    if not text:
        return np.empty((0, 2), np.int64)
    lengths = np.array([len(line) for line in text.split("\n")], np.int64)
    ends = np.cumsum(lengths + 1) - 1
    return np.column_stack([ends - lengths, ends])


def attribute(starts: np.ndarray, ends: np.ndarray, begins: np.ndarray, closes: np.ndarray, rule: str) -> tuple[np.ndarray, float]:
    """Tokens per section [begin, close) and tokens outside all sections.

    first: a token counts where its first character lies. most: where most of its characters
    lie, ties to the section named first. share: each section gets the share of the token's
    characters that it covers. A character outside all sections belongs to none.
    """
    counts = np.zeros(len(begins))
    if not len(starts):
        return counts, 0.0
    if rule == "first":
        lo, hi = np.searchsorted(starts, begins, "left"), np.searchsorted(starts, np.maximum(closes, begins), "left")
        change = np.bincount(lo, minlength=len(starts) + 1) - np.bincount(hi, minlength=len(starts) + 1)
        return counts + hi - lo, float((np.cumsum(change)[:-1] == 0).sum())
    # Tokens lo..hi-1 overlap a section; those strictly between its first and last lie inside.
    lo, hi = np.searchsorted(ends, begins, "right"), np.searchsorted(starts, closes, "left")
    hi = np.where(closes > begins, np.maximum(hi, lo), lo)
    section = np.repeat(np.arange(len(begins)), hi - lo)
    token = np.arange(len(section)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + np.repeat(lo, hi - lo)
    overlap = np.minimum(ends[token], closes[section]) - np.maximum(starts[token], begins[section])
    length = ends[token] - starts[token]
    if rule == "share":
        counts = np.bincount(section, overlap / length, len(begins))
        return counts, float(max(len(starts) - counts.sum(), 0.0))
    order = np.lexsort((section, -overlap, token))
    best = order[np.r_[True, np.diff(token[order]) != 0]] if len(order) else order
    return np.bincount(section[best], minlength=len(begins)), float(len(starts) - len(best))


def section_tokens(docs: DataFrame, tokenizer: str, rule: str = "most", id_col: str = "doc_id", text_col: str = "text", sections_col: str | None = None) -> DataFrame:
    """(doc_id, section, n_tokens) for every section, and a row with section null for tokens outside all.

    `sections_col` holds structs (section, start, end) in characters, end exclusive, in any
    order; without it the sections are the lines of the text, numbered from 0. The sum over a document's rows is its number of tokens unless sections overlap
    under `first` or `share`. The row with section null is always there, so null and empty
    texts have one row with 0; null or empty sections get 0 tokens. Repeated rows are counted
    each; an empty table gives no rows. n_tokens is a double under `share`, else bigint. A
    document's tokens and sections are held by one task, its sections being part of its row.
    """
    if rule not in RULES:
        raise ValueError(f"the rule is one of {RULES}")
    kind, arrow = ("double", pa.float64()) if rule == "share" else ("bigint", pa.int64())
    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoder = _encoder(tokenizer)
        ids, names, numbers = [], [], []
        for doc, text, sections in zip(*(c.to_pylist() for c in batch.columns)):
            _, starts, ends = encoder.tokens(text)
            if sections_col:
                sections = [s for s in sections or () if s]
                spans, named = np.array([(s["start"] or 0, s["end"] or 0) for s in sections], np.int64).reshape(-1, 2), [s["section"] for s in sections]
            else:
                spans = line_spans(text)
                named = list(range(len(spans)))
            counts, outside = attribute(starts, ends, spans[:, 0], spans[:, 1], rule)
            ids += [doc] * (len(named) + 1)
            names += [*named, None]
            numbers += [*counts.tolist(), outside]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(names, pa.int64()), pa.array(numbers, pa.float64()).cast(arrow)], names=["doc_id", "section", "n_tokens"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), (F.col(sections_col) if sections_col else F.lit(None)).cast(SECTIONS).alias("sections"))
    return over_batches(rows, count, f"doc_id bigint, section bigint, n_tokens {kind}")


_ENCODERS: dict[str, WholeTexts] = {}


def _encoder(path: str) -> WholeTexts:
    """One encoder per worker, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WholeTexts(path)
    return _ENCODERS[path]
