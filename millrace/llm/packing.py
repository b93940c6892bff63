"""Cost-balanced packing of token sequences.

A piece of n tokens costs linear * n + quadratic * n ** 2, the second part being attention
within the piece. Documents longer than a sequence give whole sequences; what is left of
every document is packed in windows of WINDOW remainders as they come: a window opens as many
sequences as its tokens need, takes the remainders from the longest to the shortest, and puts
each into the cheapest sequence that still has room for it. A remainder that fits nowhere
fills the cheapest sequence with room and goes on with its rest. The last tokens of a window
open sequences of the powers of two that add up to them, so no sequence is padded.

Encoding and packing are one pass without a shuffle: a task holds a window of remainders, at
most WINDOW * (capacity - 1) ids, and the longest document. A rerun task reads the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.byte_bpe import WholeTexts

WINDOW = 8192
ROWS = 1000  # pieces of a batch that leaves a task, unless one document or window has more
SEQUENCE_BITS = 36  # sequences that one task may open; its number is in the bits above
OUTPUT = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, sequence_tokens bigint, sequence_cost double, ids binary"


def room_for(total: int, capacity: int) -> np.ndarray:
    """Sizes of the sequences of a window: full ones, then the powers of two of what is left."""
    rest = total % capacity
    return np.array([capacity] * (total // capacity) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1], np.int64)


def balanced(lengths: np.ndarray, capacity: int, linear: float, quadratic: float) -> tuple[list[tuple[int, int, int, int, int]], np.ndarray, np.ndarray]:
    """Pieces (item, start, length, sequence, offset), and the sizes and costs of the sequences.

    Items go from the longest to the shortest, equal ones in their order; of equally cheap
    sequences the first is taken. Every sequence ends up full.
    """
    size = room_for(int(lengths.sum()), capacity)
    room, cost, out = size.copy(), np.zeros(len(size)), []
    for item in np.argsort(-lengths, kind="stable").tolist():
        start, left = 0, int(lengths[item])
        while left:
            fits = np.flatnonzero(room >= left)
            fits = fits if len(fits) else np.flatnonzero(room)
            at = int(fits[cost[fits].argmin()])
            n = min(left, int(room[at]))
            out.append((item, start, n, at, int(size[at] - room[at])))
            room[at] -= n
            cost[at] += linear * n + quadratic * n * n
            start, left = start + n, left - n
    return out, size, cost


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 0, linear: float = 1.0, quadratic: float = 1 / 1024,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: (doc_id, start, length, doc_tokens, sequence_id, offset, sequence_tokens, sequence_cost, ids).

    `ids` are the piece's ids as little-endian unsigned 32-bit integers, `start` its place in
    the document, `offset` in the sequence. Each document is its ids and end_id. A null or
    empty text is end_id alone; a null id is kept; repeated rows are documents of their own,
    packed like others; ties of length go by row order; an empty table gives no piece; other
    columns are ignored. capacity is a power of two.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity is a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = WholeTexts(tokenizer), np.array([end_id], np.uint32)
        held: list[tuple[int | None, int, int, np.ndarray]] = []  # document, place, document's tokens, ids
        ready: list[tuple] = []
        opened, first = 0, 0

        def rows(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found))
            return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:7]], pa.array(columns[7], pa.float64()), pa.array(columns[8], pa.binary())],
                                              names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "sequence_tokens", "sequence_cost", "ids"])

        def window() -> list[tuple]:
            pieces, size, cost = balanced(np.array([len(h[3]) for h in held]), capacity, linear, quadratic)
            return [(held[i][0], held[i][1] + start, n, held[i][2], first + opened + at, offset, int(size[at]), float(cost[at]), held[i][3][start : start + n].astype("<u4").tobytes())
                    for i, start, n, at, offset in pieces]

        full_cost = linear * capacity + quadratic * capacity * capacity
        for batch in batches:
            for part, doc, text in zip(*(c.to_pylist() for c in batch.columns)):
                first = part << SEQUENCE_BITS
                ids = np.concatenate([encoder.ids(text), end])
                whole = len(ids) // capacity
                ready += [(doc, k * capacity, capacity, len(ids), first + opened + k, 0, capacity, full_cost, ids[k * capacity : (k + 1) * capacity].astype("<u4").tobytes())
                          for k in range(whole)]
                opened += whole
                if len(ids) % capacity:
                    held.append((doc, whole * capacity, len(ids), ids[whole * capacity :]))
                if len(held) == WINDOW:
                    ready += window()
                    opened += len(room_for(sum(len(h[3]) for h in held), capacity))
                    held = []
                if len(ready) >= ROWS:
                    yield rows(ready)
                    ready = []
        ready += window() if held else []
        if ready:
            yield rows(ready)

    named = docs.select(F.spark_partition_id().cast("bigint").alias("part"), F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return named.mapInArrow(run, OUTPUT)
