"""Token ids in Huffman-coded blocks, written in document order and read back.

Ids of whole documents are packed into blocks that close at a document's end. Global counts
of the ids give one canonical Huffman code whose lengths are limited (package-merge). Every
block is coded by itself and carries the bit offset of each CHECKPOINT-th id, so a reader can
start at any block and decode all its stretches side by side with one table lookup per id.

File format, a folder of Parquet files: `blocks` with one row per block (part, seq, first,
doc_ids, lengths, bit_offsets, payload), ordered by (part, seq), `first` being the ids of the
part before the block; `code` with (id, bits), from which the canonical code follows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.byte_bpe import WholeTexts
from millrace.llm.texts import list_column, over_batches
from millrace.session import cut, scratch_path

BLOCK_IDS = 65_536
CHECKPOINT = 256
MAX_BITS = 16
VOCABULARY = 1_000_000  # ids above this are refused, as counts and code are held in one place

_ENCODERS: dict[str, WholeTexts] = {}
_BLOCKS = "part int, seq bigint, first bigint, doc_ids array<bigint>, lengths array<bigint>"


def packed_ids(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(part, seq, first, doc_ids, lengths, ids): documents in ascending id order, end_id after each.

    Partitions are ranges of ids; within one, blocks are numbered as they are written.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _ENCODERS:
            _ENCODERS[tokenizer] = WholeTexts(tokenizer)
        encoder, end = _ENCODERS[tokenizer], np.array([end_id], np.uint32)
        part, seq, first, size, held, docs_held, lengths = 0, 0, 0, 0, [], [], []

        def block() -> pa.RecordBatch:
            ids = np.concatenate(held)
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([seq], pa.int64()), pa.array([first], pa.int64()), pa.array([docs_held], pa.list_(pa.int64())),
                pa.array([lengths], pa.list_(pa.int64())), pa.array([ids.astype("<u4").tobytes()], pa.binary())], names=["part", "seq", "first", "doc_ids", "lengths", "ids"])

        for batch in batches:
            for part, doc, text in zip(*(c.to_pylist() for c in batch.columns)):
                held += [encoder.ids(text), end]
                docs_held.append(doc)
                lengths.append(len(held[-2]) + 1)
                size += lengths[-1]
                if size >= BLOCK_IDS:
                    yield block()
                    seq, first, size, held, docs_held, lengths = seq + 1, first + size, 0, [], [], []
        if held:
            yield block()

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.select(F.spark_partition_id().alias("part"), "doc_id", "text").mapInArrow(run, _BLOCKS + ", ids binary")


def id_counts(blocks: DataFrame) -> DataFrame:
    """(id, n) over all blocks."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = np.zeros(0, np.int64)
        for raw in batch.column(0).to_pylist():
            more = np.bincount(np.frombuffer(raw, "<u4"))
            n, more = (n, more) if len(n) >= len(more) else (more, n)
            n[: len(more)] += more
        ids = np.flatnonzero(n)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n[ids], pa.int64())], names=["id", "n"])

    return over_batches(blocks.select("ids"), count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Bits of each symbol in an optimal prefix code with at most `limit` bits (package-merge).

    More symbols than 2 ** limit raise the limit to what they need. Symbols are taken in
    (count, position) order, so equal counts have one result.
    """
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    limit = max(limit, int(n - 1).bit_length())
    order = np.lexsort((np.arange(n), counts))
    weights = np.asarray(counts, np.float64)[order]
    levels, row, leaf = [], weights, np.ones(n, bool)
    for _ in range(limit):
        levels.append(leaf)
        packages = row[: len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
        row = np.concatenate([weights, packages])
        leaf = np.arange(len(row)) < n
        merge = np.argsort(row, kind="stable")
        row, leaf = row[merge], leaf[merge]
    bits, take = np.zeros(n, np.int64), 2 * n - 2
    for leaf in reversed(levels):
        chosen = int(leaf[:take].sum())
        bits[:chosen] += 1
        take = 2 * (take - chosen)
    out = np.zeros(n, np.int64)
    out[order] = bits
    return out


def canonical(ids: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """The code of each symbol: ascending by (bits, id), each the last plus one, shifted to its length."""
    codes, code, last = np.zeros(len(ids), np.int64), 0, 0
    for i in np.lexsort((ids, bits)):
        code <<= int(bits[i] - last)
        codes[i], last = code, bits[i]
        code += 1
    return codes


class Coder:
    """Encoding and decoding tables of one code."""

    def __init__(self, ids: np.ndarray, bits: np.ndarray):
        self.width = int(bits.max()) if len(bits) else 1
        if self.width > 24:
            raise ValueError("codes above 24 bits are not supported")
        size = int(ids.max()) + 1 if len(ids) else 1
        codes, self.bits = canonical(ids, bits), np.zeros(size, np.uint8)
        self.bits[ids] = bits
        self.codes = np.zeros(size, np.uint64)
        self.codes[ids] = codes.astype(np.uint64)
        left = np.zeros(size, np.uint32)
        left[ids] = codes << (self.width - bits)
        order = np.argsort(left[ids], kind="stable")
        self.symbols = np.repeat(ids[order].astype(np.uint32), 1 << (self.width - bits[order]))
        self.symbols = np.concatenate([self.symbols, np.zeros((1 << self.width) - len(self.symbols), np.uint32)])
        self.lengths = np.maximum(self.bits[np.minimum(self.symbols, size - 1)], 1).astype(np.int64)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Payload and the bit offset of every CHECKPOINT-th id."""
        if not len(ids):
            return b"", np.empty(0, np.int64)
        bits, codes = self.bits[ids].astype(np.int64), self.codes[ids]
        ends = np.cumsum(bits)
        starts = ends - bits
        # Codes are laid into words of 64 bits from the high end; one that crosses a border leaves its rest to the next word.
        word, room = starts >> 6, 64 - (starts & 63) - bits
        crossing = np.flatnonzero(room < 0)
        shift = np.maximum(room, 0).astype(np.uint64)
        laid = codes << shift
        over = (-room[crossing]).astype(np.uint64)
        laid[crossing] = codes[crossing] >> over
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        words = np.zeros(int(word[-1]) + 2, np.uint64)
        words[word[first]] = np.add.reduceat(laid, first)
        words[word[crossing] + 1] |= codes[crossing] << (np.uint64(64) - over)
        return words.byteswap().tobytes()[: (int(ends[-1]) + 7) // 8], starts[::CHECKPOINT]

    def decode(self, payload: bytes, offsets: np.ndarray, count: int) -> np.ndarray:
        """The ids of a block; each step decodes one id of all stretches."""
        raw = np.frombuffer(payload + b"\0" * 5, np.uint8).astype(np.uint64)
        window = raw[:-4] << np.uint64(32) | raw[1:-3] << np.uint64(24) | raw[2:-2] << np.uint64(16) | raw[3:-1] << np.uint64(8) | raw[4:]
        window, at, mask = window.astype(np.int64), offsets.astype(np.int64), (1 << self.width) - 1
        out = np.empty((CHECKPOINT, len(offsets)), np.uint32)
        edge = len(window) - 1
        for step in range(min(CHECKPOINT, count)):
            key = (window[np.minimum(at >> 3, edge)] >> (40 - self.width - (at & 7))) & mask
            out[step] = self.symbols[key]
            at = at + self.lengths[key]
        return out.T.reshape(-1)[:count]


def coded_blocks(blocks: DataFrame, ids: np.ndarray, bits: np.ndarray) -> DataFrame:
    """Replace the ids of the blocks by bit offsets and payload."""
    holder: list[Coder] = []

    def code(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not holder:
            holder.append(Coder(ids, bits))
        done = [holder[0].encode(np.frombuffer(b, "<u4")) for b in batch.column(5).to_pylist()]
        return pa.RecordBatch.from_arrays([*batch.columns[:5], list_column([d[1] for d in done], pa.int64()), pa.array([d[0] for d in done], pa.binary())],
                                          names=[*batch.schema.names[:5], "bit_offsets", "payload"])

    return over_batches(blocks, code, _BLOCKS + ", bit_offsets array<bigint>, payload binary")


def write_token_files(docs: DataFrame, tokenizer: str, path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Write the token files of all documents below `path` and return it.

    Documents come in ascending id order, ties by text, null ids first; a null text is empty
    and has the end id only; repeated rows are written as often as they come; an empty table
    gives files without rows. Other columns are ignored. A document lies in one block, so a
    task holds the longest document of its range and a block beside it.
    """
    spark = docs.sparkSession
    blocks = cut(packed_ids(docs, tokenizer, end_id, id_col, text_col))
    rows = id_counts(blocks).limit(VOCABULARY + 1).collect()
    if len(rows) > VOCABULARY:
        raise ValueError(f"more than {VOCABULARY} different ids")
    rows.sort(key=lambda r: r["id"])
    ids, counts = np.array([r["id"] for r in rows], np.int64), np.array([r["n"] for r in rows], np.int64)
    bits = code_lengths(counts)
    coded_blocks(blocks, ids, bits).write.parquet(f"{path}/blocks")
    spark.createDataFrame([(int(i), int(b)) for i, b in zip(ids, bits)], "id bigint, bits int").coalesce(1).write.parquet(f"{path}/code")
    return path


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files.

    start counts the ids of all documents before it; ids_crc32 is the unsigned CRC-32 of its
    ids as little-endian unsigned 32-bit integers.
    """
    code = spark.read.parquet(f"{path}/code").orderBy("id").collect()
    ids, bits = np.array([r["id"] for r in code], np.int64), np.array([r["bits"] for r in code], np.int64)
    blocks = spark.read.parquet(f"{path}/blocks")
    # One row per partition of the writer.
    parts = blocks.groupBy("part").agg(F.sum(F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("n"))
    before, total = {}, 0
    for row in sorted(parts.collect(), key=lambda r: r["part"]):
        before[row["part"]], total = total, total + row["n"]
    holder: list[Coder] = []

    def read(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not holder:
            holder.append(Coder(ids, bits))
        docs, starts, sizes, sums = [], [], [], []
        for part, _, first, names, lengths, offsets, payload in zip(*(c.to_pylist() for c in batch.columns)):
            decoded = holder[0].decode(payload, np.array(offsets, np.int64), sum(lengths)).astype("<u4").tobytes()
            at = 0
            for name, n in zip(names, lengths):
                docs.append(name)
                starts.append(before[part] + first + at)
                sizes.append(n)
                sums.append(zlib.crc32(decoded[4 * at : 4 * (at + n)]))
                at += n
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (docs, starts, sizes, sums)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    columns = blocks.select("part", "seq", "first", "doc_ids", "lengths", "bit_offsets", "payload")
    return over_batches(columns, read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_file_digest(docs: DataFrame, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the token files to the shared folder and read them back."""
    spark = docs.sparkSession
    return read_token_files(spark, write_token_files(docs, tokenizer, scratch_path(spark, "tokens"), end_id, id_col, text_col))
