"""Bytes that repeat what a document with a smaller id says, found with a run-length index.

A repeat is a string of `span` bytes that also starts in a document with a smaller id. Each
window of that length has a key, the smallest hash of its shorter grams, so equal windows have
equal keys; neighbours mostly share theirs, so a text is cut into segments of windows with one
key. Documents are packed into batches, and equal keys meet by key range:

1. Every batch sends its distinct keys with the bytes behind each, rounded up to a power of
   two, and learns by one bit per key which of them other batches or several of its own
   documents have. A range whose shared keys hold more than RANGE_LIMIT calls the heaviest
   of them crowded, until the rest is within it.
2. Segments with a shared key go to the key's range; of equal segments in a batch only that of
   the smallest id is sent, the others stay behind and take over its answer.
3. A range builds the run-length index of its distinct segments and streams them through it.
   Where a window's match group starts in a smaller id, the window is marked. Segments of
   which no window is met twice, by a hash that equal windows share, match only themselves
   and are left out of the index.
4. Windows with a crowded key go by a second key, the 128-bit digest of the whole window: once
   per batch, without text, to ranges of digests. There the smallest id marks all others.
5. Marks come back to the batch, where the bytes they cover are cut out.

So a range holds at most RANGE_LIMIT bytes of text, however many documents share a key, and a
digest meets itself at most once per batch. A longer document is a batch of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.run_index import LONGEST, RunIndex
from millrace.llm.texts import raw_texts, settle
from millrace.session import cut

BATCH_BYTES = 2 << 20
RANGE_BYTES = 2 << 20  # of text per range of keys
RANGE_LIMIT = 8 << 20  # of segments in a range; heavier keys are split by whole windows
SLICE = 1 << 15  # windows that are hashed together
_C1, _C2, _C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_LAST_ID = np.iinfo(np.int64).max


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of all strings of `size` bytes, combined from hashes of powers of two."""
    part = (data.astype(np.uint64) + np.uint64(1)) * _C1
    part ^= part >> np.uint64(29)
    out, done, width = None, 0, 1
    while size:
        if size & 1:
            if out is None:
                out, done = part, width
            else:
                n = len(part) - done
                out = out[:n] * _C2 ^ part[done:]
                out *= _C1
                out ^= out >> np.uint64(31)
                done += width
        size >>= 1
        if size:
            n = len(part) - width
            part = part[:n] * _C3 ^ part[width:]
            part *= _C1
            part ^= part >> np.uint64(30)
            width *= 2
    return out


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum over each `width` neighbours."""
    have, out = 1, values
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def segments(data: np.ndarray, lengths: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, document, first window, windows) of the segments of documents laid out one after another."""
    empty = np.empty(0, np.int64)
    if len(data) < span:
        return empty.astype(np.uint64), empty, empty, empty
    # Slice by slice, so that the arrays stay in a core's cache.
    keys = np.concatenate([window_minima(gram_hashes(data[a : a + SLICE + span - 1], gram), span - gram + 1) for a in range(0, len(data) - span + 1, SLICE)])
    ends = np.cumsum(lengths)
    opens = np.empty(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=opens[1:])
    starts = ends - lengths
    opens[starts[starts < len(keys)]] = True
    first = np.flatnonzero(opens)
    doc = np.searchsorted(ends, first, "right")
    # Windows that would reach beyond the document are none.
    count, most = np.minimum(np.r_[first[1:], len(keys)], ends[doc] - span + 1) - first, LONGEST - span + 1
    inside = np.flatnonzero(count > 0)
    if not len(inside):
        return empty.astype(np.uint64), empty, empty, empty
    first, doc, count = first[inside], doc[inside], count[inside]
    pieces = -(-count // most)
    nth = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first, count = np.repeat(first, pieces) + nth * most, np.minimum(np.repeat(count, pieces) - nth * most, most)
    # Minima crowd at the low end; mixed anew (one to one) they spread over the ranges.
    spread = keys[first] * _C2
    spread = (spread ^ (spread >> np.uint64(32))) * _C3
    return spread ^ (spread >> np.uint64(29)), np.repeat(doc, pieces), first, count


def _packed(docs: DataFrame, text_col: str) -> DataFrame:
    """(batch, size, rows): documents with all their columns, packed as compressed Arrow streams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, size = TaskContext.get().partitionId() << 32, 0, [], 0

        def pack() -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=9))) as out:
                out.write_table(pa.Table.from_batches(held).combine_chunks())
            return pa.RecordBatch.from_arrays([pa.array([part + number], pa.int64()), pa.array([size], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["batch", "size", "rows"])

        for batch in batches:
            lengths = np.array([len(t or b"") for t in raw_texts(batch.column(text_col))], np.int64)
            at = 0
            while at < len(lengths):
                room = np.searchsorted(np.cumsum(lengths[at:]), BATCH_BYTES - size, "right")
                end = min(len(lengths), at + max(int(room), 0 if held else 1))
                if end > at:
                    held.append(batch.slice(at, end - at))
                    size += int(lengths[at:end].sum())
                    at = end
                if at < len(lengths):
                    yield pack()
                    number, held, size = number + 1, [], 0
        if held:
            yield pack()

    return docs.mapInArrow(run, "batch bigint, size bigint, rows binary")


class _Batch:
    """A packed batch: its rows, and its texts as one array."""

    def __init__(self, packed: bytes, id_col: str, text_col: str):
        self.rows = pa.ipc.open_stream(packed).read_all().combine_chunks()
        texts = self.rows.column(text_col).combine_chunks() if self.rows.num_rows else pa.array([], pa.string())
        raws = [t or b"" for t in raw_texts(texts)]
        self.data = np.frombuffer(b"".join(raws), np.uint8)
        self.lengths = np.array([len(r) for r in raws], np.int64)
        self.ids = self.rows.column(id_col).combine_chunks().cast(pa.int64()).fill_null(_LAST_ID).to_numpy(zero_copy_only=False)


def _shrunk(body: bytes) -> bytes:
    return pa.Codec("zstd", compression_level=6).compress(body, asbytes=True)


def _grown(body: bytes, size: int) -> bytes:
    return pa.Codec("zstd").decompress(body, size, asbytes=True) if size else b""


def _ranges(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64)


def _asked(batches: DataFrame, bits: int, span: int, gram: int, id_col: str, text_col: str) -> DataFrame:
    """(batch, range, n, shared, crowded): bits of the distinct keys of a batch, in ascending order."""

    def ask(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in stream:
            for name, packed in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                held = _Batch(packed, id_col, text_col)
                keys, doc, _, count = segments(held.data, held.lengths, span, gram)
                order = np.argsort(keys, kind="stable")
                keys, doc, size = keys[order], held.ids[doc[order]], count[order] + span - 1
                first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
                if not len(first):
                    continue
                several = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
                weight = np.ceil(np.log2(np.add.reduceat(size, first))).astype(np.uint8)
                keys = keys[first]
                to, start = np.unique(_ranges(keys, bits), return_index=True)
                stop = np.r_[start[1:], len(keys)]
                # The range gives the leading bits; the next 40 tell keys apart well enough for a first look.
                low = ((keys << np.uint64(bits)) >> np.uint64(24)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
                yield pa.RecordBatch.from_arrays([pa.array(to, pa.int64()), pa.array(np.full(len(to), name), pa.int64()),
                                                  pa.array([low[a:b].tobytes() for a, b in zip(start, stop)], pa.binary()),
                                                  pa.array([np.packbits(several[a:b]).tobytes() for a, b in zip(start, stop)], pa.binary()),
                                                  pa.array([weight[a:b].tobytes() for a, b in zip(start, stop)], pa.binary())], names=["range", "batch", "keys", "several", "weights"])

    def answer(group: pa.Table) -> pa.Table:
        raws = group["keys"].to_pylist()
        sizes = np.array([len(r) // 5 for r in raws])
        wide = np.zeros((int(sizes.sum()), 8), np.uint8)
        wide[:, :5] = np.frombuffer(b"".join(raws), np.uint8).reshape(-1, 5)
        keys = wide.view("<u8").ravel()
        ordered = np.sort(keys)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        own = np.concatenate([np.unpackbits(np.frombuffer(s, np.uint8), count=n) for s, n in zip(group["several"].to_pylist(), sizes)]).astype(bool)
        shared = np.isin(keys, twice) | own
        crowded = np.zeros(len(keys), bool)
        mass = np.left_shift(1, np.frombuffer(b"".join(group["weights"].to_pylist()), np.uint8)[shared].astype(np.int64))
        if mass.sum() > RANGE_LIMIT:
            names, number = np.unique(keys[shared], return_inverse=True)
            per_key = np.bincount(number, weights=mass)
            order = np.argsort(per_key, kind="stable")
            crowded[shared] = np.isin(number, order[np.cumsum(per_key[order]) > RANGE_LIMIT])
        at = np.cumsum(sizes) - sizes
        bits_of = lambda flags: pa.array([np.packbits(flags[a : a + n]).tobytes() for a, n in zip(at, sizes)], pa.binary())
        return pa.table({"batch": group["batch"], "range": group["range"], "n": pa.array(sizes, pa.int64()), "shared": bits_of(shared),
                         "crowded": bits_of(crowded) if crowded.any() else pa.nulls(len(sizes), pa.binary())})

    sent = batches.select("batch", "rows").mapInArrow(ask, "range bigint, batch bigint, keys binary, several binary, weights binary")
    return sent.groupBy("range").applyInArrow(answer, "batch bigint, range bigint, n bigint, shared binary, crowded binary")


_SENT = "range bigint, batch bigint, ids binary, firsts binary, counts binary, origins binary, bytes binary"


def _sent_row(to: int, batch: int, body: bytes = b"", **columns: np.ndarray) -> tuple:
    return to, batch, *[columns[name].tobytes() if name in columns else b"" for name in ("ids", "firsts", "counts", "origins")], body


def _sent_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 5]
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], names=["range", "batch", "ids", "firsts", "counts", "origins", "bytes"])


def _stay(batch: int, ids: np.ndarray, first: np.ndarray, count: np.ndarray, origin: np.ndarray) -> Iterator[tuple]:
    """Rows for the batch itself on what equals another place of it, its origin, and is not sent.

    With a larger id than the origin it is marked; with the same id it is marked where the origin is.
    """
    known = ids[origin] < ids
    alike = ~known & (origin != np.arange(len(ids)))
    firsts, counts = first.astype(np.uint32), count.astype(np.uint8)
    if known.any():
        yield _sent_row(-1 - batch, batch, firsts=firsts[known], counts=counts[known])
    if alike.any():
        yield _sent_row(-1 - batch, batch, firsts=firsts[alike], counts=counts[alike], origins=firsts[origin[alike]])


def _digests(raw: bytes, at: np.ndarray, span: int) -> np.ndarray:
    """(n, 2) words of the 128-bit digests of the windows that start at these places."""
    parts = [b"".join([blake2b(raw[a : a + span], digest_size=16).digest() for a in at[k : k + SLICE].tolist()]) for k in range(0, len(at), SLICE)]
    return np.frombuffer(b"".join(parts), "<u8").reshape(-1, 2)


def _runs(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The places of all windows of runs."""
    return np.arange(int(count.sum())) + np.repeat(first - (np.cumsum(count) - count), count)


def _sent(batches: DataFrame, answers: DataFrame, bits: int, span: int, gram: int, id_col: str, text_col: str) -> DataFrame:
    """Segments with shared keys by range, windows with crowded keys by digest from range 1 << bits on.

    Negative ranges hold what one batch has to tell itself.
    """

    def send(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in stream:
            for name, packed, replies in zip(*(c.to_pylist() for c in rows.columns)):
                out = list(told(name, packed, replies))
                if out:
                    yield _sent_rows(out)
        settle()

    def told(name: int, packed: bytes, replies: list[dict]) -> Iterator[tuple]:
        held = _Batch(packed, id_col, text_col)
        keys, doc, first, count = segments(held.data, held.lengths, span, gram)
        replies = sorted(replies, key=lambda r: r["range"])
        shared = np.concatenate([np.unpackbits(np.frombuffer(r["shared"], np.uint8), count=r["n"]) for r in replies]).astype(bool)
        crowded = np.concatenate([np.zeros(r["n"], np.uint8) if r["crowded"] is None else np.unpackbits(np.frombuffer(r["crowded"], np.uint8), count=r["n"]) for r in replies]).astype(bool)
        _, number = np.unique(keys, return_inverse=True)
        pick = np.flatnonzero(shared[number])
        pick = pick[np.lexsort((first[pick], held.ids[doc[pick]], keys[pick]))]
        keys, ids, first, count, split = keys[pick], held.ids[doc[pick]], first[pick], count[pick], crowded[number[pick]]
        raw = held.data.tobytes()
        strings = [raw[a:b] for a, b in zip(first.tolist(), (first + count + span - 1).tolist())]
        met: dict[bytes, int] = {}
        origin = np.array([met.setdefault(s, j) for j, s in enumerate(strings)], np.int64)  # the smallest id comes first
        yield from _stay(name, ids, first, count, origin)
        own = origin == np.arange(len(origin))
        go = np.flatnonzero(own & ~split)
        to, start = np.unique(_ranges(keys[go], bits), return_index=True)
        for r, part in zip(to.tolist(), np.split(go, start[1:])):
            yield _sent_row(r, name, _shrunk(b"".join([strings[j] for j in part.tolist()])), ids=ids[part], firsts=first[part].astype(np.uint32), counts=count[part].astype(np.uint8))
        del met, strings
        go = np.flatnonzero(own & split)
        if not len(go):
            return
        at, ids = _runs(first[go], count[go]), np.repeat(ids[go], count[go])
        order = np.lexsort((at, ids))
        at, ids = at[order], ids[order]
        digest = _digests(raw, at, span)
        order = np.lexsort((digest[:, 1], digest[:, 0]))  # stable: the smallest id of equals comes first
        at, ids, digest = at[order], ids[order], digest[order]
        fresh = np.r_[True, (digest[1:] != digest[:-1]).any(axis=1)]
        yield from _stay(name, ids, at, np.ones(len(at), np.int64), np.flatnonzero(fresh)[np.cumsum(fresh) - 1])
        at, ids, digest = at[fresh], ids[fresh], digest[fresh]
        to, start = np.unique(_ranges(digest[:, 0], bits), return_index=True)
        for r, part in zip(to.tolist(), np.split(np.arange(len(at)), start[1:])):
            yield _sent_row((1 << bits) + r, name, digest[part].tobytes(), ids=ids[part], firsts=at[part].astype(np.uint32))

    replies = answers.groupBy("batch").agg(F.collect_list(F.struct("range", "n", "shared", "crowded")).alias("replies"))
    return batches.join(replies, "batch").select("batch", "rows", "replies").mapInArrow(send, _SENT)


def _met(data: np.ndarray, lengths: np.ndarray, span: int) -> np.ndarray:
    """Which of the strings, laid out one after another, may have a window that comes again.

    Equal windows have equal hashes, so a string that is left out has none.
    """
    hashes = np.concatenate([gram_hashes(data[a : a + SLICE + span - 1], span) for a in range(0, len(data) - span + 1, SLICE)])
    windows = lengths - span + 1
    hashes = hashes[_runs(np.cumsum(lengths) - lengths, windows)]
    order = np.argsort(hashes)
    again = hashes[order[1:]] == hashes[order[:-1]]
    out, owner = np.zeros(len(lengths), bool), np.repeat(np.arange(len(lengths)), windows)
    out[owner[order[1:][again]]] = True
    out[owner[order[:-1][again]]] = True
    return out


def _marks(names: np.ndarray, firsts: np.ndarray, counts: np.ndarray) -> pa.Table:
    order = np.lexsort((firsts, names))
    names, firsts, counts = names[order], firsts[order].astype(np.uint32), counts[order].astype(np.uint32)
    which, start = np.unique(names, return_index=True)
    stop = np.r_[start[1:], len(names)].astype(np.int64)
    return pa.table({"batch": pa.array(which, pa.int64()), "firsts": pa.array([firsts[a:b].tobytes() for a, b in zip(start, stop)], pa.binary()),
                     "counts": pa.array([counts[a:b].tobytes() for a, b in zip(start, stop)], pa.binary()), "origins": pa.array([b""] * len(which), pa.binary())})


def _marked(sent: DataFrame, bits: int, span: int) -> DataFrame:
    """(batch, firsts, counts, origins): runs of marked windows as places in the batch; with origins, marked where these are."""

    def mark(group: pa.Table) -> pa.Table:
        to = group["range"][0].as_py()
        if to < 0:
            counts = [np.frombuffer(b, np.uint8).astype(np.uint32).tobytes() for b in group["counts"].to_pylist()]
            return pa.table({"batch": group["batch"], "firsts": group["firsts"], "counts": pa.array(counts, pa.binary()), "origins": group["origins"]})
        column = lambda name, kind: np.concatenate([np.frombuffer(b, kind) for b in group[name].to_pylist()])
        ids, first = column("ids", np.int64), column("firsts", np.uint32).astype(np.int64)
        rows = [len(b) // 8 for b in group["ids"].to_pylist()]
        batch = np.repeat(group["batch"].to_numpy(), rows)
        if to >= 1 << bits:
            digest = column("bytes", "<u8").reshape(-1, 2)
            order = np.lexsort((ids, digest[:, 1], digest[:, 0]))
            fresh = np.flatnonzero(np.r_[True, (digest[order[1:]] != digest[order[:-1]]).any(axis=1)])
            least = np.repeat(ids[order[fresh]], np.diff(np.r_[fresh, len(order)]))
            hits = order[least < ids[order]]
            return _marks(batch[hits], first[hits], np.ones(len(hits), np.int64))
        count = column("counts", np.uint8).astype(np.int64)
        whole = np.r_[0, np.cumsum(count + span - 1)][np.cumsum([0, *rows])]
        body = b"".join([_grown(b, int(n)) for b, n in zip(group["bytes"].to_pylist(), np.diff(whole))])
        ends = np.cumsum(count + span - 1)
        strings = [body[a:b] for a, b in zip((ends - count - span + 1).tolist(), ends.tolist())]
        order = np.argsort(ids, kind="stable")
        numbers: dict[bytes, int] = {}
        owner, of = [], np.empty(len(ids), np.int64)
        for j in order.tolist():  # ascending ids: the first to bring a string owns it
            number = numbers.setdefault(strings[j], len(numbers))
            if number == len(owner):
                owner.append(int(ids[j]))
            of[j] = number
        owners, texts = np.array(owner), list(numbers)
        lengths = np.array([len(t) for t in texts])
        width = int(lengths.max()) - span + 1
        earliest = np.repeat(owners[:, None], width, axis=1)
        met = np.flatnonzero(_met(np.frombuffer(b"".join(texts), np.uint8), lengths, span))
        if len(met):
            index = RunIndex(np.frombuffer(b"".join([texts[j] for j in met.tolist()]), np.uint8), lengths[met], span)
            string, offset, row = index.matches()
            # Owners ascend, so the smallest owner number of a group has the smallest id.
            earliest[met[string], offset] = owners[met[index.first_owner[index.group[row]]]]
            del index
        hits = earliest[of] < ids[:, None]
        hits[np.arange(width) >= count[:, None]] = False
        edge = np.diff(np.pad(hits, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        who, begin = np.nonzero(edge == 1)
        _, end = np.nonzero(edge == -1)
        out = _marks(batch[who], first[who] + begin, end - begin)
        del earliest, hits, edge, numbers, strings, texts, body
        settle()
        return out

    return sent.groupBy("range").applyInArrow(mark, "batch bigint, firsts binary, counts binary, origins binary")


def _finished(docs: DataFrame, schema: str, finish: Callable[[pa.Table, list[bytes], list[list[dict]], list[bytes]], pa.Table], id_col: str, text_col: str, span: int, gram: int) -> DataFrame:
    batches = cut(_packed(docs, text_col))
    total = batches.agg(F.sum("size")).first()[0] or 0
    bits = max(4, int(total // RANGE_BYTES).bit_length())
    marks = _marked(_sent(batches, _asked(batches, bits, span, gram, id_col, text_col), bits, span, gram, id_col, text_col), bits, span)
    per_batch = marks.groupBy("batch").agg(F.collect_list(F.struct("firsts", "counts", "origins")).alias("marks"))

    def apply(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in stream:
            for packed, marked in zip(*(c.to_pylist() for c in rows.columns)):
                held = _Batch(packed, id_col, text_col)
                hit = np.zeros(len(held.data) + 2, bool)  # windows; none at either end
                marks = [[np.frombuffer(m[c], np.uint32).astype(np.int64) for c in ("firsts", "counts", "origins")] for m in marked or ()]
                copies = [m for m in marks if len(m[2])]
                for firsts, counts, origins in [m for m in marks if not len(m[2])] + copies + copies:  # a segment's origin may have windows with origins
                    hit[_runs(firsts, counts) + 1] = hit[_runs(origins, counts) + 1] if len(origins) else True
                edge = np.diff(hit.astype(np.int8))
                change = np.zeros(len(held.data) + span, np.int64)
                change[np.flatnonzero(edge == 1)] += 1
                change[np.flatnonzero(edge == -1) + span - 1] -= 1
                gone = np.cumsum(change[: len(held.data)]) > 0
                spans, kept, raws, at = [], [], [], 0
                for n in held.lengths.tolist():
                    own, bytes_ = gone[at : at + n], held.data[at : at + n]
                    edge = np.diff(np.r_[False, own, False].astype(np.int8))
                    spans.append([{"start": a, "end": b} for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())])
                    raws.append(bytes_.tobytes())
                    kept.append(bytes_[~own].tobytes() if spans[-1] else raws[-1])
                    at += n
                yield from finish(held.rows, raws, spans, kept).to_batches()
        settle()

    return batches.join(per_batch, "batch", "left").select("rows", "marks").mapInArrow(apply, schema)


_SPANS = "array<struct<start:bigint,end:bigint>>"
_SPAN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = 50, gram: int = 24) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) per row: the maximal byte runs to remove and the bytes that stay.

    Strings are judged on the input, matches never cross documents, and only smaller ids count:
    repeats within a document, and rows that share an id, stay. Null texts are empty; a row
    without an id is cleaned against all others and cleans none. Texts shorter than `span`
    stay. An empty table gives no rows; further columns are ignored.
    """

    def finish(rows: pa.Table, raws: list[bytes], spans: list[list[dict]], kept: list[bytes]) -> pa.Table:
        return pa.table({"doc_id": rows.column(0), "n_bytes": pa.array([len(r) for r in raws], pa.int64()), "spans": pa.array(spans, _SPAN_TYPE), "kept": pa.array(kept, pa.binary())})

    named = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return _finished(named, f"doc_id bigint, n_bytes bigint, spans {_SPANS}, kept binary", finish, "doc_id", "text", span, gram)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = 50, gram: int = 24) -> DataFrame:
    """The same rows and columns with the repeated bytes cut out of the text.

    Characters of which only some bytes are left are dropped with them; a null text stays null.
    """

    def finish(rows: pa.Table, raws: list[bytes], spans: list[list[dict]], kept: list[bytes]) -> pa.Table:
        was = rows.column(text_col).to_pylist()
        texts = [w if not s else k.decode(errors="ignore") for w, s, k in zip(was, spans, kept)]
        return rows.set_column(rows.schema.get_field_index(text_col), text_col, pa.array(texts, pa.string()))

    return _finished(docs, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), finish, id_col, text_col, span, gram)
