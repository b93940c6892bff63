"""Alignment of two tokenizers over the same bytes, and corpus-wide counts of aligned id pairs.

Both tokenizers cut the bytes of a text into tokens; where tokens of both end at the same
byte, a group of tokens closes. The ascending ends of A and B are merged along a merge path:
diagonals at equal distances are searched for the place where the path crosses them, which
divides the merge into pieces of equal work that know nothing of each other. A piece gives the
ends both have within it; an end whose A half closes one piece and whose B half opens the next
is found when neighbouring pieces are stitched. A batch of documents is one merge, laid end to
end, so long and short documents make the same pieces.

Links are the pairs of A and B tokens of a group. Per document they are kept as distinct id
pairs with how often they occur; a block of documents adds its distinct pairs with the number
of documents that hold them. Blocks, not documents, are joined with the corpus counts, so a
pair that every document holds comes once per block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.byte_bpe import WholeTexts
from millrace.session import cut

PIECE = 65_536  # merged ends of a piece
BATCH_BYTES = 1 << 21  # text that is merged at a time, unless one document is longer
BLOCK_PAIRS = 1_000_000  # distinct pairs, summed over the documents of a block
LINKS = 1 << 22  # pairs laid out at a time
DOCUMENTS = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"


class Pieces:
    """The B side: a sentencepiece model's ids and the bytes of its pieces."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode())

    def ids(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


def crossings(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many of `a` lie before each diagonal of the merge of two ascending arrays, equal ends of `a` first."""
    low, high = np.maximum(diagonals - len(b), 0), np.minimum(diagonals, len(a))
    while (low < high).any():
        mid = (low + high) >> 1
        other = diagonals - 1 - mid
        before = np.where((mid < high) & (other >= 0), a[np.minimum(mid, len(a) - 1)] <= b[np.clip(other, 0, len(b) - 1)], False) if len(a) and len(b) else np.zeros(len(mid), bool)
        low, high = np.where((low < high) & before, mid + 1, low), np.where((low < high) & ~before, mid, high)
    return low


def common_ends(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Places in `a` and in `b` of the values that both ascending arrays hold."""
    total = len(a) + len(b)
    diagonals = np.append(np.arange(0, total, piece), total)
    at_a = crossings(a, b, diagonals)
    at_b = diagonals - at_a
    found_a, found_b = [], []
    for k in range(len(diagonals) - 1):
        lo, hi, start, stop = at_a[k], at_a[k + 1], at_b[k], at_b[k + 1]
        if k and lo and start < len(b) and start < stop and a[lo - 1] == b[start]:  # the two halves of one end lie on both sides of the border
            found_a.append(np.array([lo - 1]))
            found_b.append(np.array([start]))
        mine, theirs = a[lo:hi], b[start:stop]
        if len(mine) and len(theirs):
            place = np.searchsorted(theirs, mine)
            same = np.flatnonzero((place < len(theirs)) & (theirs[np.minimum(place, len(theirs) - 1)] == mine))
            found_a.append(lo + same)
            found_b.append(start + place[same])
    if not found_a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_a), np.concatenate(found_b)


class GroupText:
    """Texts `a1,a2|b1;a3|b2,b3` of groups, put together from words of eight bytes: digits, a mark, zeros."""

    def __init__(self, size_a: int, size_b: int):
        n = max(size_a, size_b)
        if n > 10**7:
            raise ValueError("ids above seven digits are not supported")
        self.word = {mark: np.char.mod(f"%d{mark}", np.arange(n)).astype("S8").view(np.uint64) for mark in ",|;"}
        self.length = np.char.str_len(self.word[","].view("S8")).astype(np.int64)

    def laid(self, ids_a: np.ndarray, ids_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The text of all groups, each followed by `;`, and where each group ends in it."""
        sizes_a, sizes_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        at_a = np.arange(len(ids_a)) + np.repeat(last_b - sizes_b + 1, sizes_a)
        at_b = np.arange(len(ids_b)) + np.repeat(last_a + 1, sizes_b)
        words = np.empty(len(ids_a) + len(ids_b), np.uint64)
        for at, ids, last, mark in ((at_a, ids_a, last_a, "|"), (at_b, ids_b, last_b, ";")):
            row = self.word[","][ids]
            row[last] = self.word[mark][ids[last]]
            words[at] = row
        ends = np.cumsum(self.length[ids_a])[last_a] + np.cumsum(self.length[ids_b])[last_b]
        return words.tobytes().translate(None, b"\0"), ends


def linked_pairs(ids_a: np.ndarray, ids_b: np.ndarray, doc: np.ndarray, last_a: np.ndarray, last_b: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, pair, how often) of all A-B pairs of the groups, pair being a * width + b; sorted."""
    sizes_a, sizes_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
    first_a, first_b = last_a - sizes_a + 1, last_b - sizes_b + 1
    links = sizes_a * sizes_b
    parts, begin, reach = [], 0, width * (int(ids_a.max()) + 1) if len(ids_a) else 1
    upto = np.cumsum(links)
    while begin < len(links):
        stop = max(begin + 1, int(np.searchsorted(upto, upto[begin] - links[begin] + LINKS, "right")))
        if links[begin] > LINKS:  # one wide group: distinct ids of both sides with their numbers
            a, many_a = np.unique(ids_a[first_a[begin] : last_a[begin] + 1], return_counts=True)
            b, many_b = np.unique(ids_b[first_b[begin] : last_b[begin] + 1], return_counts=True)
            parts.append((doc[begin] * reach + (a[:, None] * width + b).ravel(), (many_a[:, None] * many_b).ravel()))
        else:
            span = slice(begin, stop)
            group = np.repeat(np.arange(begin, stop), links[span])
            within = np.arange(len(group)) - np.repeat(upto[span] - links[span] - (upto[begin] - links[begin]), links[span])
            one, other = np.divmod(within, sizes_b[group])
            key = np.sort(doc[group] * reach + ids_a[first_a[group] + one] * width + ids_b[first_b[group] + other])
            fresh = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            parts.append((key[fresh], np.diff(fresh, append=len(key))))
        begin = stop
    key, many = (np.concatenate(c) for c in zip(*parts)) if parts else (np.empty(0, np.int64), np.empty(0, np.int64))
    if len(parts) > 1:
        order = np.argsort(key, kind="stable")
        key, many = key[order], many[order]
        fresh = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        key, many = key[fresh], np.add.reduceat(many, fresh)
    return key // reach, key % reach, many


class Aligner:
    """Both tokenizers and their tables, once per task."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = WholeTexts(path_a, plain=True), Pieces(path_b)
        self.bytes_a, self.bytes_b = np.array(self.a.bytes, object), np.array(self.b.bytes, object)
        self.sizes_a, self.sizes_b = (np.array([len(t) for t in side], np.int64) for side in (self.a.bytes, self.b.bytes))
        self.text = GroupText(len(self.a.bytes), len(self.b.bytes))
        self.width = len(self.b.bytes)

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides, or none where their bytes are not those of the text behind a space."""
        if not text:
            return None
        whole = " " + text
        ids_a, ids_b = self.a.ids(whole).astype(np.int64), np.array(self.b.ids(text), np.int64)
        raw = whole.encode()
        if b"".join(self.bytes_a[ids_a].tolist()) != raw or b"".join(self.bytes_b[ids_b].tolist()) != raw:
            return None
        return ids_a, ids_b

    def aligned(self, texts: list[str | None]) -> tuple[dict[str, list], tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Columns per text, and (place of the text, pair, how often) of all links."""
        found = [self.tokens(t) for t in texts]
        n = len(texts)
        out = {"n_a": np.zeros(n, np.int64), "n_b": np.zeros(n, np.int64), "n_groups": np.zeros(n, np.int64), "n_links": np.zeros(n, np.int64), "groups_sha256": [""] * n}
        used = [i for i, f in enumerate(found) if f]
        if not used:
            return out, (np.empty(0, np.int64),) * 3
        out["n_a"][used] = [len(found[i][0]) for i in used]
        out["n_b"][used] = [len(found[i][1]) for i in used]
        ids_a, ids_b = (np.concatenate([found[i][side] for i in used]) for side in (0, 1))
        last_a, last_b = common_ends(np.cumsum(self.sizes_a[ids_a]), np.cumsum(self.sizes_b[ids_b]))
        ends_a = np.cumsum(out["n_a"][used])
        doc = np.searchsorted(ends_a, last_a, "right")  # documents end together on both sides, so no group crosses them
        out["n_groups"][used] = np.bincount(doc, minlength=len(used))
        links = np.diff(last_a, prepend=-1) * np.diff(last_b, prepend=-1)
        out["n_links"][used] = np.add.reduceat(links, np.searchsorted(doc, np.arange(len(used))))
        text, ends = self.text.laid(ids_a, ids_b, last_a, last_b)
        text, at = memoryview(text), 0
        for i, end in zip(used, ends[np.cumsum(out["n_groups"][used]) - 1].tolist()):
            out["groups_sha256"][i] = hashlib.sha256(text[at : end - 1]).hexdigest()
            at = end
        owner, pair, many = linked_pairs(ids_a, ids_b, doc, last_a, last_b, self.width)
        return out, (np.array(used)[owner] if len(owner) else owner, pair, many)


def _encoded(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per document with its pairs, and one per block of documents (doc_id null, is_block) with its distinct pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(path_a, path_b)
        block, size, seen = 0, 0, []
        part = 0

        def rows(ids: list, found: dict[str, list], blocks: list[int], pairs: list[bytes], many: list[bytes], is_block: bool) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), *[pa.array(found[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")], pa.array(found["groups_sha256"], pa.string()),
                pa.array([is_block] * len(ids)), pa.array([part] * len(ids), pa.int64()), pa.array(blocks, pa.int64()), pa.array(pairs, pa.binary()), pa.array(many, pa.binary())],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "is_block", "part", "block", "pairs", "many"])

        def closed() -> pa.RecordBatch:
            pair, n = np.unique(np.concatenate(seen), return_counts=True)
            return rows([None], {"n_a": [0], "n_b": [0], "n_groups": [0], "n_links": [0], "groups_sha256": [""]}, [block], [pair.tobytes()], [n.astype(np.uint32).tobytes()], True)

        def merged(ids: list, texts: list) -> Iterator[pa.RecordBatch]:
            nonlocal block, size, seen
            found, (owner, pair, many) = aligner.aligned(texts)
            starts = np.searchsorted(owner, np.arange(len(texts) + 1))
            yield rows(ids, found, [block] * len(ids), [pair[a:b].tobytes() for a, b in zip(starts, starts[1:])], [many[a:b].astype(np.uint32).tobytes() for a, b in zip(starts, starts[1:])], False)
            seen.append(pair)
            size += len(pair)
            if size >= BLOCK_PAIRS:
                yield closed()
                block, size, seen = block + 1, 0, []

        for batch in batches:
            ids, texts, held = [], [], 0
            for part, doc, text in zip(*(c.to_pylist() for c in batch.columns)):
                ids.append(doc)
                texts.append(text)
                held += len(text or "")
                if held >= BATCH_BYTES:
                    yield from merged(ids, texts)
                    ids, texts, held = [], [], 0
            if ids:
                yield from merged(ids, texts)
        if size:
            yield closed()

    named = docs.select(F.spark_partition_id().cast("bigint").alias("part"), F.col("doc_id"), F.col("text"))
    return named.mapInArrow(run, DOCUMENTS + ", is_block boolean, part bigint, block bigint, pairs binary, many binary")


def _pair_rows(blocks: DataFrame, width: int) -> DataFrame:
    """(part, block, a, b, n): documents of the block that hold the pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, block, pairs, many in zip(*(c.to_pylist() for c in batch.columns)):
                pair, n = np.frombuffer(pairs, np.int64), np.frombuffer(many, np.uint32).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pair), part)), pa.array(np.full(len(pair), block)), pa.array(pair // width), pa.array(pair % width), pa.array(n)],
                                                 names=["part", "block", "a", "b", "n"])

    return blocks.select("part", "block", "pairs", "many").mapInArrow(run, "part bigint, block bigint, a bigint, b bigint, n bigint")


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, pairs): the alignment of every document, and (a, b, n, best) of every linked id pair of the corpus.

    documents has doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best (links whose
    count is the highest of their A id, ties included) and count_sum (counts summed over
    links). n counts documents, so repeated rows count as often as they come. Texts that are
    null or empty, or whose tokens do not give back their bytes (B writes U+2581 as a space),
    have no tokens, zeros and ''. A null id is kept; an empty table gives empty results; other
    columns are ignored. A task holds BATCH_BYTES of text, or one longer text, and the pairs of
    a block.
    """
    width = len(Pieces(path_b).bytes)
    encoded = cut(_encoded(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")), path_a, path_b))
    met = cut(_pair_rows(encoded.where("is_block"), width))
    totals = met.groupBy("a", "b").agg(F.sum("n").alias("n"))
    highest = totals.groupBy("a").agg(F.max("n").alias("most"))
    pairs = cut(totals.join(highest, "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best")))
    known = met.select("part", "block", "a", "b").join(pairs, ["a", "b"]).select("part", "block", (F.col("a") * width + F.col("b")).alias("pair"), "n", "best")
    rows = encoded.where("not is_block").select(*[c.split(" ")[0] for c in DOCUMENTS.split(", ")], "part", "block", "pairs", "many")

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(right["pair"].to_numpy())
        pair, n, best = right["pair"].to_numpy()[order], right["n"].to_numpy()[order], right["best"].to_numpy()[order]
        n_best, count_sum = [], []
        for pairs, many in zip(left["pairs"], left["many"]):
            at, many = np.searchsorted(pair, np.frombuffer(pairs, np.int64)), np.frombuffer(many, np.uint32).astype(np.int64)
            n_best.append(int(many[best[at].astype(bool)].sum()))
            count_sum.append(int((many * n[at]).sum()))
        return left.drop(columns=["part", "block", "pairs", "many"]).assign(n_best=n_best, count_sum=count_sum)

    scored = rows.groupBy("part", "block").cogroup(known.groupBy("part", "block")).applyInPandas(score, DOCUMENTS + ", n_best bigint, count_sum bigint")
    return scored, pairs
