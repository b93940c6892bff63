"""Distinct sampled segmentations of whole texts by Gumbel top-k search, and their decoding.

Pieces of a SentencePiece model get unigram probabilities trained on the corpus: distinct
chunks are counted in Spark, each is encoded once, and piece counts are added up. The lattice
of a text is a chain of small lattices, cut where no piece holds both neighbours.

Sampling without replacement is an A*-like search over sets of segmentations. A set is "the
first words as in path r, the word at j other than what was taken there, the rest free". Its
perturbed score, the maximum of the Gumbel-perturbed log-probabilities of its members, is a
Gumbel variable around the log of its mass, cut off at the score of the set it came from; it
bounds all members exactly. The best set gives the next segmentation, its other members split
into one set per later word. The best score left over after k samples is the threshold t of
the inclusion probabilities 1 - exp(-exp(log p - t)).

Building the lattices of distinct chunks, drawing, scoring and decoding run over the words of
many documents at once. Every random number is a hash of (row key, seed, sample, word, step), so a
row's samples depend neither on its partition nor on other rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.texts import over_batches, settle

SPACE = "▁"
CHUNK = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
BATCH_CHARS = 1_000_000  # characters sampled side by side in a task; a longer text goes alone
COUNTED = 300_000  # chunks that a task counts before it passes them on
GATHERED = 1 << 15  # characters whose lattices are built together
LOW = 512
KEPT_EDGES = 2_000_000  # edges of chunk lattices kept by a worker; it starts anew beyond them


def chunks(text: str) -> list[str]:
    """The chunks of a text with the leading space that the model adds; none for an empty text."""
    return CHUNK.findall(SPACE + text.replace(" ", SPACE)) if text else []


_MODELS: dict = {}


def _processor(path: str):
    if path not in _MODELS:
        import sentencepiece

        _MODELS[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _MODELS[path]


def piece_counts(docs: DataFrame, model: str, text_col: str = "text") -> DataFrame:
    """(piece, n): how often the model's own encoding of all texts uses each piece."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()  # by what follows a space; a line end stands with the word behind it
        other: Counter = Counter()

        def rows() -> pa.RecordBatch:
            for word in [w for w in found if w[:1] == "\n"]:
                n = found.pop(word)
                other["\n"] += n
                if len(word) > 1:
                    other[word[1:]] += n
            names = [*[SPACE + w for w in found], *other]
            out = pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([*found.values(), *other.values()], pa.int64())], names=["chunk", "n"])
            found.clear()
            other.clear()
            return out

        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text and text[0] != " " and "  " not in text and SPACE not in text:
                    found.update(text.replace("\n", " \n").split(" "))
                elif text:
                    other.update(chunks(text))
                if len(found) + len(other) > COUNTED:
                    yield rows()
        if found or other:
            yield rows()
        settle()

    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "chunk string, n bigint").groupBy("chunk").agg(F.sum("n").alias("n"))

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        sp = _processor(model)
        names, counts = batch.column(0).to_pylist(), batch.column(1).to_numpy()
        # The model adds a space in front; where a chunk has none it is encoded after a line end.
        lead = len(sp.encode("\n"))
        coded = sp.encode([c[1:].replace(SPACE, " ") if c[0] == SPACE and len(c) > 1 else "\n" + c.replace(SPACE, " ") for c in names], num_threads=1)
        coded = [ids if c[0] == SPACE and len(c) > 1 else ids[lead:] for c, ids in zip(names, coded)]
        total = np.bincount(np.array([i for ids in coded for i in ids], np.int64), np.repeat(counts, [len(ids) for ids in coded]), sp.get_piece_size())
        used = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used].astype(np.int64))], names=["piece", "n"])

    return over_batches(counted, encode, "piece bigint, n bigint").groupBy("piece").agg(F.sum("n").alias("n"))


def log_probabilities(counts: DataFrame, model: str, smoothing: float = 1.0) -> np.ndarray:
    """Log-probability of each piece of the model; as many numbers as it has pieces."""
    total = np.zeros(_processor(model).get_piece_size())
    for row in counts.collect():  # at most one row per piece of the model
        total[row["piece"]] = row["n"]
    total += smoothing
    return np.log(total / total.sum())


_M1, _M2, _G = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


class Lattices:
    """Lattices of chunks as flat edge tables, each with one conditional probability per edge.

    A text is cut wherever no piece holds the two characters side by side, so no piece is lost.
    Edges of one place stand together, most probable first, as (conditional probability up to
    and with this edge, log of the edge's own conditional probability, places ahead, code); a
    character without a piece gets its UTF-8 bytes as one edge. The log-probability of a path
    is the sum of its edges' conditional logs. Numbers of a chunk depend on that chunk alone.
    """

    def __init__(self, model: str, logs: np.ndarray, temperature: float):
        sp = _processor(model)
        self.logs = logs / temperature
        pieces: dict[str, int] = {}
        self.bytes = [0] * 256
        texts: list[bytes] = [b""] * sp.get_piece_size()
        for i in range(sp.get_piece_size()):
            name = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(name[3:5], 16)
                self.bytes[value] = i
                texts[i] = bytes([value])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                pieces[name] = i
                texts[i] = name.replace(SPACE, " ").encode()
        self.texts, self.longest = texts, max(map(len, pieces))
        # Codes: a piece id, or beyond them a character as a run of byte pieces.
        self.runs: dict[int, int] = {}
        self.code_ids: list[tuple[int, ...]] = [(i,) for i in range(len(texts))]
        self.code_logs = list(self.logs)
        self.log_table = np.empty(0)
        self.runs_laid, self.table = None, None  # made when first needed
        # Characters of pieces by number; 0 is any other.
        letters = sorted(set("".join(pieces)), key=lambda c: (c != SPACE, c))
        self.letter = np.zeros(0x110000, np.int32)
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.radix = len(letters) + 1
        pairs = {(int(self.letter[ord(x)]), int(self.letter[ord(y)])) for p in pieces for x, y in zip(p, p[1:])}
        self.pairs = np.unique(np.array([x * self.radix + y for x, y in pairs], np.int64))
        self.low_pairs = np.zeros((LOW, LOW), bool)  # of the first letters, which most texts are made of
        for x, y in pairs:
            if x < LOW and y < LOW:
                self.low_pairs[x, y] = True
        # A trie of the pieces as sorted (node, letter) keys.
        nodes, ends, edges = {"": 0}, [-1], []
        for name in sorted(pieces):
            for k in range(1, len(name) + 1):
                if name[:k] not in nodes:
                    nodes[name[:k]] = len(ends)
                    edges.append((nodes[name[: k - 1]] * self.radix + int(self.letter[ord(name[k - 1])]), len(ends)))
                    ends.append(-1)
            ends[nodes[name]] = pieces[name]
        edges.sort()
        self.keys, self.child = (np.array(c, np.int64) for c in zip(*edges))
        self.ends = np.array(ends, np.int64)
        # Where each key stands, by its hash; the next free slot where that is taken.
        self.slots = np.full(1 << (4 * len(self.keys)).bit_length(), -1, np.int32)
        waiting, slot = np.arange(len(self.keys)), self._slot(self.keys)
        while len(waiting):
            free = self.slots[slot[waiting]] < 0
            self.slots[slot[waiting[free]]] = waiting[free]
            waiting = waiting[self.slots[slot[waiting]] != waiting]
            slot[waiting] = (slot[waiting] + 1) % len(self.slots)
        self.roots = np.full(self.radix, -1, np.int64)
        roots = self.keys < self.radix
        self.roots[self.keys[roots]] = self.child[roots]
        self._forget()

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * _G >> np.uint64(65 - len(self.slots).bit_length())).astype(np.int64)

    def _ahead(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of those keys that the trie has, nodes they lead to)."""
        slot = self._slot(key)
        at = self.slots[slot]
        astray = np.flatnonzero((at >= 0) & (self.keys[at] != key))
        while len(astray):
            slot[astray] = (slot[astray] + 1) % len(self.slots)
            at[astray] = self.slots[slot[astray]]
            astray = astray[(at[astray] >= 0) & (self.keys[at[astray]] != key[astray])]
        hit = np.flatnonzero(at >= 0)
        return hit, self.child[at[hit]]

    def _forget(self) -> None:
        self.prints, self.kinds = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.room = {k: np.empty(0, t) for k, t in (("place", np.int64), ("size", np.int32), ("sole", bool), ("first", np.int32), ("cumulated", float), ("log", float), ("of", np.int32), ("step", np.min_scalar_type(self.longest)), ("code", np.int32))}
        self.laid = dict(self.room)

    def _lay(self, more: dict[str, np.ndarray]) -> None:
        """Put lattices behind those held, in room that doubles when it is used up."""
        shift = {"place": len(self.laid["first"]), "of": len(self.laid["first"]), "first": len(self.laid["step"])}
        for k, new in more.items():
            have = len(self.laid[k])
            end = have + len(new)
            if end > len(self.room[k]):
                self.room[k] = np.empty(max(2 * end, 1024), self.room[k].dtype)
                self.room[k][:have] = self.laid[k]
            np.add(new, shift[k], out=self.room[k][have:end], casting="unsafe") if k in shift else np.copyto(self.room[k][have:end], new, casting="unsafe")
            self.laid[k] = self.room[k][:end]

    def split(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(code points, start of each chunk, chunks per text) of texts that are not empty."""
        points = np.frombuffer("".join([SPACE + t for t in texts]).replace(" ", SPACE).encode("utf-32-le"), np.uint32).astype(np.int64)
        letters = self.letter[points].astype(np.int64)
        low = np.minimum(letters, LOW - 1)
        joined = self.low_pairs[low[:-1], low[1:]]
        high = np.flatnonzero((letters[:-1] >= LOW) | (letters[1:] >= LOW))
        key = letters[high] * self.radix + letters[high + 1]
        joined[high] = self.pairs[np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)] == key
        begins = np.cumsum([0, *[len(t) + 1 for t in texts]])
        fresh = np.r_[True, ~joined]
        fresh[begins[:-1]] = True
        starts = np.flatnonzero(fresh)
        return points, starts, np.diff(np.searchsorted(starts, begins))

    def known(self, points: np.ndarray, starts: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """(lattices of all chunks met so far, kind of each chunk); chunks are told apart by a 64-bit hash."""
        if len(self.laid["step"]) > KEPT_EDGES:
            self._forget()
        sizes = np.diff(np.r_[starts, len(points)])
        at = np.arange(len(points)) - np.repeat(starts, sizes)
        parts = (points.astype(np.uint64) + (at.astype(np.uint64) << np.uint64(21))) * _G
        parts = (parts ^ (parts >> np.uint64(31))) * _M1
        parts ^= parts >> np.uint64(29)
        prints, first, kind = np.unique(np.add.reduceat(parts, starts) * _M2 + sizes.astype(np.uint64), return_index=True, return_inverse=True)
        where = np.minimum(np.searchsorted(self.prints, prints), max(len(self.prints) - 1, 0))
        new = np.flatnonzero(self.prints[where] != prints) if len(self.prints) else np.arange(len(prints))
        if len(new):
            own, have = first[new], len(self.laid["size"])
            # Slice by slice, so that the arrays stay in a core's cache.
            upto = np.cumsum(sizes[own])
            for part in np.split(own, np.flatnonzero(np.diff(upto // GATHERED)) + 1):
                lengths = sizes[part]
                flat = np.repeat(starts[part] - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))
                self._lay(self.gather(points[flat], lengths))
            # Both are in order, so the new ones go between those held.
            at = np.searchsorted(self.prints, prints[new])
            self.prints = np.insert(self.prints, at, prints[new])
            self.kinds = np.insert(self.kinds, at, have + np.arange(len(new)))
            where = np.searchsorted(self.prints, prints)
        return self.laid, self.kinds[where][kind]

    def _fallback(self, point: int) -> int:
        if point not in self.runs:
            ids = tuple(self.bytes[b] for b in chr(point).encode())
            self.runs[point] = len(self.code_ids)
            self.code_ids.append(ids)
            self.code_logs.append(float(sum(self.logs[i] for i in ids)))
        return self.runs[point]

    def gather(self, points: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
        """The lattices of chunks that stand one after another; `place` is a chunk's first place, `first` a place's first edge, `of` an edge's place."""
        n = len(points)
        place = np.cumsum(sizes) - sizes
        left = np.repeat(place + sizes, sizes) - np.arange(n)
        letters, node, active = self.letter[points].astype(np.int64), np.zeros(n, np.int64), np.arange(n)
        found, single = [], np.zeros(n, bool)
        for step in range(1, self.longest + 1):
            on = np.flatnonzero(left[active] >= step)
            active, node = active[on], node[on]
            if step == 1:
                ahead = self.roots[letters]
                hit = np.flatnonzero(ahead >= 0)
                ahead = ahead[hit]
            else:
                hit, ahead = self._ahead(node * self.radix + letters[active + step - 1])
            active, node = active[hit], ahead
            piece = self.ends[node]
            whole = np.flatnonzero(piece >= 0)
            found.append((active[whole], np.full(len(whole), step), piece[whole]))
            if step == 1:
                single[active[whole]] = True
        bare = np.flatnonzero(~single)
        found.append((bare, np.ones(len(bare), np.int64), np.array([self._fallback(int(p)) for p in points[bare]], np.int64)))
        of, step, code = (np.concatenate(c) for c in zip(*found))
        # From the last place of all chunks to the first: log of the sum over the paths ahead.
        wide = max(n - 1, 0).bit_length() + 6
        order = order_of((left[of] << wide) + (of << 6) + step, wide + int(left.max(initial=0)).bit_length())
        of, step, code = of[order], step[order], code[order]
        if len(self.log_table) < len(self.code_logs):
            self.log_table = np.array(self.code_logs)
        log = self.log_table[code]
        chunk = np.repeat(np.arange(len(sizes)), sizes)
        after, slot = np.zeros(n + len(sizes)), np.arange(n) + chunk  # one more slot per chunk for its end
        target, value = slot[of] + step, np.empty(len(of))
        depth = left[of]
        bounds = np.flatnonzero(np.r_[True, depth[1:] != depth[:-1], True])
        heads = np.r_[True, of[1:] != of[:-1]]
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            value[a:b] = log[a:b] + after[target[a:b]]
            head = np.flatnonzero(heads[a:b])
            top = np.maximum.reduceat(value[a:b], head)
            size = np.diff(np.r_[head, b - a])
            after[slot[of[a:b][head]]] = top + np.log(np.add.reduceat(np.exp(value[a:b] - np.repeat(top, size)), head))
        own = value - after[slot[of]]
        share = np.exp(own)
        # In the order of steps already, so equal shares keep it.
        order = order_of((of << 31) + ((1 << 29) - (share * (1 << 29)).astype(np.int64)), wide + 25)
        of, step, code, own, share = of[order], step[order], code[order], own[order], share[order]
        first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        count = np.diff(np.r_[first, len(of)])
        cumulated = np.empty(len(of))
        run, edge = np.zeros(n), first.copy()
        for k in range(int(count.max(initial=0))):
            here = np.flatnonzero(count > k)
            run[here] += share[edge[here] + k]
            cumulated[edge[here] + k] = run[here]
        cumulated[first + count - 1] = 2.0
        return {"place": place, "size": sizes, "first": first, "cumulated": cumulated, "log": own, "of": of, "step": step, "code": code,
                "sole": ~np.logical_or.reduceat(count > 1, place)}

    def of_names(self, names: list[str]) -> dict[str, np.ndarray]:
        """The lattices of some chunks given as strings."""
        points = np.frombuffer("".join(names).encode("utf-32-le"), np.uint32).astype(np.int64)
        return self.gather(points, np.array([len(w) for w in names], np.int64))


def order_of(key: np.ndarray, bits: int) -> np.ndarray:
    """Stable order of keys from 0 to below 2 ** bits; packed with their places, where both fit, they sort much faster."""
    own = len(key).bit_length()
    if bits + own > 63:
        return np.argsort(key, kind="stable")
    return np.sort((key << own) + np.arange(len(key))) & ((1 << own) - 1)


def uniform(key: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from 64-bit keys (splitmix finaliser)."""
    z = key * _G
    z = (z ^ (z >> np.uint64(30))) * _M1
    z = (z ^ (z >> np.uint64(27))) * _M2
    z ^= z >> np.uint64(31)
    return ((z >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52


def mixed(*parts: np.ndarray | int) -> np.ndarray:
    """One 64-bit key from several numbers."""
    out = np.zeros(1, np.uint64)
    for part in parts:
        z = (out ^ np.asarray(part).astype(np.uint64)) * _G
        z = (z ^ (z >> np.uint64(29))) * _M1
        out = z ^ (z >> np.uint64(32))
    return out


_MASK = (1 << 64) - 1


def draw(key: int) -> float:
    """The same as `uniform`, for one whole number."""
    z = key * int(_G) & _MASK
    z = (z ^ (z >> 30)) * int(_M1) & _MASK
    z = (z ^ (z >> 27)) * int(_M2) & _MASK
    return (((z ^ (z >> 31)) >> 12) + 0.5) * 2.0**-52


def walk(lattices: dict[str, np.ndarray], kind: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Draw a path for each word: (edges in word order, edges per word, log-probability per word)."""
    place, left = lattices["place"][kind], lattices["size"][kind]
    logs, counts = np.zeros(len(kind)), np.zeros(len(kind), np.int64)
    active, taken, owners, step = np.arange(len(kind)), [], [], 0
    while len(active):
        # place, left and key are those of the active words
        u = uniform(key + np.uint64(step))
        edge = lattices["first"].take(place).astype(np.int64)
        behind = np.flatnonzero(u > lattices["cumulated"].take(edge))
        while len(behind):
            edge[behind] += 1
            behind = behind[u.take(behind) > lattices["cumulated"].take(edge.take(behind))]
        logs[active] += lattices["log"].take(edge)
        counts[active] += 1
        taken.append(edge)
        owners.append(active)
        ahead = lattices["step"].take(edge)
        left = left - ahead
        on = np.flatnonzero(left > 0)
        active, place, left, key, step = active.take(on), (place + ahead).take(on), left.take(on), key.take(on), step + 1
    starts = np.cumsum(counts) - counts
    out = np.empty(int(counts.sum()), np.int64)
    for depth, (edge, owner) in enumerate(zip(taken, owners)):
        out[starts[owner] + depth] = edge
    return out, counts, logs


class Barred:
    """Some segmentations of one word as a trie, and the log-probability of all others at each of its nodes.

    Another segmentation leaves the trie at some node by an edge that the trie does not have, so
    its mass is a sum over such edges; one less the mass of the barred ones would cancel.
    """

    def __init__(self, lattices: dict[str, np.ndarray], paths: list[tuple[int, ...]]):
        self.log, self.of, self.first = lattices["log"], lattices["of"], lattices["first"]
        self.nodes: list[tuple[int, int, dict[int, int]]] = []  # first edge of the place, edge after its last, {edge: node}
        waiting = [(paths, 0, -1)]
        while waiting:
            group, depth, parent = waiting.pop()
            children: dict[int, list] = {}
            for path in group:
                if len(path) > depth:
                    children.setdefault(path[depth], []).append(path)
            at = len(self.nodes)
            if not children:  # the end of a barred path
                self.nodes.append((0, 0, {}))
            else:
                place = int(self.of[next(iter(children))])
                high = int(self.first[place + 1]) if place + 1 < len(self.first) else len(self.log)
                self.nodes.append((int(self.first[place]), high, dict.fromkeys(children, -1)))
            if parent >= 0:
                self.nodes[parent][2][group[0][depth - 1]] = at
            waiting += [(below, depth + 1, at) for below in children.values()]
        self.rest = [-math.inf] * len(self.nodes)
        for at in reversed(range(len(self.nodes))):  # children come after their parents
            weights = self.weights(at)
            top = max(weights, default=-math.inf)
            if top > -math.inf:
                self.rest[at] = top + math.log(sum([math.exp(w - top) for w in weights]))

    def weights(self, at: int) -> list[float]:
        """Log-mass of what is not barred behind each edge of a node."""
        low, high, children = self.nodes[at]
        out = self.log[low:high].tolist()
        for edge, below in children.items():
            out[edge - low] += self.rest[below]
        return out


def other_path(lattices: dict[str, np.ndarray], kind: int, barred: list[tuple[int, ...]], key: int) -> tuple[tuple[int, ...], float]:
    """A path of one word drawn among those not barred, and its log-probability."""
    base, left = int(lattices["place"][kind]), int(lattices["size"][kind])
    trie, node, at, path, total = Barred(lattices, barred), 0, 0, [], 0.0
    while at < left:
        if node >= 0:
            low, high, children = trie.nodes[node]
            weights = trie.weights(node)
        else:
            first = lattices["first"][base + at : base + at + 2].tolist()
            low, high = first if len(first) > 1 else (first[0], len(lattices["log"]))
            children, weights = {}, lattices["log"][low:high].tolist()
        top = max(weights)
        share = [math.exp(w - top) for w in weights]
        mark, pick = draw(key + len(path)) * sum(share), low
        for edge, part in enumerate(share, low):
            if part > 0:
                pick = edge
                mark -= part
                if mark <= 0:
                    break
        node = children.get(pick, -1)
        path.append(pick)
        total += float(lattices["log"][pick])
        at += int(lattices["step"][pick])
    return tuple(path), total


def cut_gumbel(location: np.ndarray, bound: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel variables around `location`, given that they are not above `bound`."""
    return location - np.log(np.exp(np.minimum(location - bound, 700.0)) - np.log(u))


def sample_words(lattices: dict[str, np.ndarray], kind: np.ndarray, sizes: np.ndarray, keys: np.ndarray, k: int) -> list[dict]:
    """Up to k distinct segmentations per document of a batch.

    `kind` has the lattice of each word, `sizes` the words per document, all above 0. Returns
    one dict per rank: docs (positions), edges, counts per word, log-probabilities, scores;
    the last dict holds the best score left over per document (-inf if none is).
    """
    n, doc = len(sizes), np.repeat(np.arange(len(sizes)), sizes)
    start = np.cumsum(sizes) - sizes
    word = np.arange(len(kind)) - start[doc]
    paths: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
    waiting: list[list[tuple]] = [[] for _ in range(n)]  # sets of a document: (score, path, word, barred)
    alive, score = np.arange(n), -np.log(-np.log(uniform(mixed(keys, 1))))
    since, barred_at = np.zeros(n, np.int64), [()] * n
    out, spot = [], mixed(keys[doc], word)
    living = np.ones(n, bool)
    for rank in range(k):
        if rank:  # only words behind the divergence are drawn; a document without one keeps its first path
            late = np.flatnonzero((word > since[doc]) & living[doc])
            edges, counts, logs = _merged(paths, chosen, doc, word, np.where(living, since, len(kind)), replaced, late, *walk(lattices, kind[late], mixed(spot[late], 2 * rank)))
        else:
            edges, counts, logs = walk(lattices, kind, mixed(spot, 2 * rank))
        at = np.cumsum(counts) - counts
        paths.append((edges, at, counts, logs))
        total = np.add.reduceat(logs, start)
        out.append({"docs": alive, "edges": edges, "counts": counts, "log": total, "score": score})
        # One set per word from the divergence on: what shares the words before but not this one.
        before = np.cumsum(logs) - logs
        before -= before[start][doc]
        with np.errstate(divide="ignore", invalid="ignore"):
            rest = _rest_of_words(lattices, kind, edges, at, counts, logs)
            for i in alive:
                if barred_at[i]:
                    w = start[i] + since[i]
                    gone = math.fsum([math.exp(min(logs[w], 0.0)), *[math.exp(float(lattices["log"][list(b)].sum())) for b in barred_at[i]]])
                    rest[w] = math.log1p(-gone) if gone < 0.999 else Barred(lattices, [*barred_at[i], tuple(edges[at[w] : at[w] + counts[w]].tolist())]).rest[0]
            sets, open_ = np.full(len(kind), -np.inf), np.flatnonzero(np.isfinite(rest) & (word >= since[doc]) & living[doc])
            sets[open_] = cut_gumbel(before[open_] + rest[open_], score[doc[open_]], uniform(spot[open_] * _M2 + np.uint64(2 * rank + 1)))
        for _ in range(k - rank):
            top = np.maximum.reduceat(sets, start)
            hit = np.flatnonzero((sets == top[doc]) & np.isfinite(sets))
            hit = hit[np.r_[True, np.diff(doc[hit]) != 0]] if len(hit) else hit
            for w in hit.tolist():
                i, j = int(doc[w]), int(word[w])
                taken = tuple(edges[at[w] : at[w] + counts[w]].tolist())
                waiting[i].append((float(sets[w]), rank, j, (*barred_at[i], taken) if j == since[i] else (taken,)))
            sets[hit] = -np.inf
        for held in waiting:
            held.sort(key=lambda s: -s[0])
            del held[k - rank :]
        if rank + 1 < k:
            score, since, chosen, replaced, barred_at = np.full(n, -np.inf), np.zeros(n, np.int64), np.zeros(n, np.int64), {}, [()] * n
            restarts = mixed(keys, 2000 + rank).tolist()
            for i, held in enumerate(waiting):
                if held:
                    score[i], chosen[i], since[i], barred_at[i] = held.pop(0)
                    w = int(start[i] + since[i])
                    replaced[w] = other_path(lattices, int(kind[w]), list(barred_at[i]), restarts[i])
            living = np.isfinite(score)
            alive = np.flatnonzero(living)
    out.append({"left": np.array([held[0][0] if held else -np.inf for held in waiting])})
    return out


NEAR_SURE = -1e-3  # log-probability above which one less it would lose digits


def _others(lattices: dict[str, np.ndarray], edges: np.ndarray) -> np.ndarray:
    """For each edge the log of the summed probability of the other edges at its place."""
    log, first = lattices["log"][edges], lattices["first"]
    out = np.log(-np.expm1(np.minimum(log, NEAR_SURE)))
    near = np.flatnonzero(log > NEAR_SURE)
    if len(near):  # summed up, as one less a probability near one loses digits
        place = lattices["of"][edges[near]].astype(np.int64)
        begin = first[place].astype(np.int64)
        n = np.append(first, len(lattices["log"]))[place + 1] - begin
        at = np.cumsum(n) - n
        beside = np.repeat(begin - at, n) + np.arange(int(n.sum()))
        value = np.where(beside == np.repeat(edges[near], n), -np.inf, lattices["log"][beside])
        top = np.maximum.reduceat(value, at)
        top = np.where(np.isfinite(top), top, 0.0)
        out[near] = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, n)), at))
    return out


def _rest_of_words(lattices: dict[str, np.ndarray], kind: np.ndarray, edges: np.ndarray, at: np.ndarray, counts: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """Log-probability of all segmentations of each word but the one taken.

    Where that one is nearly sure, it is the sum, over its steps, of leaving it there; else one
    less its probability has all digits.
    """
    rest = np.log(-np.expm1(np.minimum(logs, NEAR_SURE)))
    near = logs > NEAR_SURE
    rest[near] = -np.inf
    near = np.flatnonzero(near & ~lattices["sole"][kind])
    if len(near):
        n = counts[near]
        begin = np.cumsum(n) - n
        own = edges[np.repeat(at[near] - begin, n) + np.arange(int(n.sum()))]
        log = lattices["log"][own]
        upto = np.cumsum(log) - log
        leaving = upto - np.repeat(upto[begin], n) + _others(lattices, own)
        top = np.maximum.reduceat(leaving, begin)
        top = np.where(np.isfinite(top), top, 0.0)
        rest[near] = top + np.log(np.add.reduceat(np.exp(leaving - np.repeat(top, n)), begin))
    return rest


def _merged(paths: list, chosen: np.ndarray, doc: np.ndarray, word: np.ndarray, since: np.ndarray, replaced: dict, late: np.ndarray, edges: np.ndarray, counts: np.ndarray, logs: np.ndarray) -> tuple:
    """Words before the divergence from the chosen path, the word there as replaced, the `late` ones as drawn."""
    pool = [edges, *[p[0] for p in paths], np.array([e for path, _ in replaced.values() for e in path], np.int64)]
    base = np.cumsum([0, *map(len, pool)])[:-1]
    source, size, log = np.zeros(len(word), np.int64), np.zeros(len(word), np.int64), np.zeros(len(word))
    source[late], size[late], log[late] = base[0] + np.cumsum(counts) - counts, counts, logs
    before = word < since[doc]
    for r, (_, at, n, own) in enumerate(paths):
        early = np.flatnonzero(before & (chosen[doc] == r))
        source[early], size[early], log[early] = base[r + 1] + at[early], n[early], own[early]
    offset = int(base[-1])
    for w, (path, own) in replaced.items():
        source[w], size[w], log[w] = offset, len(path), own
        offset += len(path)
    flat = np.repeat(source - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    return np.concatenate(pool)[flat], size, log


def decode_ids(ids: np.ndarray, table: pa.Array) -> tuple[memoryview, np.ndarray]:
    """(texts of piece ids one after another as UTF-8, with the space that encoding put in front; where each id begins, and the end)."""
    if not len(ids):
        return memoryview(b""), np.zeros(1, np.int64)
    got = table.take(pa.array(ids))
    return memoryview(got.buffers()[2] or b""), np.frombuffer(got.buffers()[1], np.int64)[: len(ids) + 1]


def _byte_table(lattices: Lattices) -> pa.Array:
    if lattices.table is None:
        lattices.table = pa.array(lattices.texts, pa.large_binary())
    return lattices.table


SCHEMA = "doc_id bigint, rank int, ids binary, log_prob double, score double, inclusion double, exact boolean"


def sample_segmentations(docs: DataFrame, model: str, k: int = 3, seed: int = 0, temperature: float = 1.0, logs: np.ndarray | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, rank, ids, log_prob, score, inclusion, exact): k distinct segmentations per row.

    ids are little-endian unsigned 32-bit piece ids. Ranks 0 to k - 1 fall by perturbed score;
    inclusion is the probability that the sample holds this segmentation, given the threshold.
    A text with fewer than k segmentations gives them all, with inclusion 1 for each. Masses
    are sums of what is left, never one less what is taken, so a segmentation is found however
    improbable it is. `exact` says whether decoding the ids gives the text back; it does unless the
    text holds the character U+2581, which stands for a space and is decoded as one. A null or
    empty text has one segmentation, without ids. Rows are keyed by id and text: repeated rows
    give equal samples, each for itself, null ids count as 0; an empty table gives no rows.
    Other columns are ignored. Without `logs` the unigram model is trained on these texts. A
    very long text is sampled whole, by one task.
    """
    if logs is None:
        logs = log_probabilities(piece_counts(docs, model, text_col), model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices = _lattices(model, logs, temperature)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at = 0
            while at < len(ids):
                end, size = at, 0
                while end < len(ids) and (end == at or size + len(texts[end] or "") <= BATCH_CHARS):
                    size += len(texts[end] or "")
                    end += 1
                yield _sampled(lattices, ids[at:end], texts[at:end], k, seed)
                at = end
        settle()

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, SCHEMA)


_LATTICES: dict[tuple, Lattices] = {}


def _lattices(model: str, logs: np.ndarray, temperature: float) -> Lattices:
    key = (model, hash(logs.tobytes()), temperature)
    if key not in _LATTICES:
        _LATTICES.clear()
        _LATTICES[key] = Lattices(model, logs, temperature)
    return _LATTICES[key]


def _sampled(lattices: Lattices, ids: list, texts: list, k: int, seed: int) -> pa.RecordBatch:
    filled = [i for i, t in enumerate(texts) if t]
    rows: list[tuple] = [(i, 0, b"", 0.0, 0.0, 1.0, True) for i, t in enumerate(texts) if not t]
    if filled:
        points, starts, sizes = lattices.split([texts[i] for i in filled])
        laid, kind = lattices.known(points, starts)
        keys = mixed(np.array([ids[i] or 0 for i in filled], np.int64), seed, np.array([xxhash.xxh3_64_intdigest(texts[i].encode()) for i in filled], np.uint64))
        *ranks, last = sample_words(laid, kind, sizes, keys, k)
        ends = np.cumsum(sizes)
        table, raws = _byte_table(lattices), [b" " + texts[i].encode() for i in filled]
        runs = _byte_runs(lattices)
        for rank, found in enumerate(ranks):
            pieces = laid["code"][found["edges"]].astype(np.int64)
            upto = np.concatenate([[0], np.cumsum(found["counts"])])[np.concatenate([[0], ends])]
            if len(pieces) and pieces.max() >= len(lattices.texts):  # some are runs of byte pieces
                size = runs[1][pieces]
                upto = np.concatenate([[0], np.cumsum(size)])[upto]
                pieces = runs[0][np.repeat(runs[2][pieces] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
            decoded, begins = decode_ids(pieces, table)
            coded, begins = pieces.astype("<u4").tobytes(), begins[upto].tolist()
            upto = (4 * upto).tolist()
            for j in found["docs"].tolist():
                log, left = float(found["log"][j]), float(last["left"][j])
                inclusion = -math.expm1(-math.exp(min(log - left, 700.0))) if left > -math.inf else 1.0
                exact = bytes(decoded[begins[j] : begins[j + 1]]) == raws[j]
                rows.append((filled[j], rank, coded[upto[j] : upto[j + 1]], log, float(found["score"][j]), inclusion, exact))
    rows.sort(key=lambda r: (r[0], r[1]))
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.float64(), pa.float64(), pa.float64(), pa.bool_()]
    columns = list(zip(*rows)) if rows else [()] * 7
    columns[0] = [ids[i] for i in columns[0]]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["doc_id", "rank", "ids", "log_prob", "score", "inclusion", "exact"])


def _byte_runs(lattices: Lattices) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece ids of every code laid out one after another, ids per code, first id of each code)."""
    if lattices.runs_laid is None or len(lattices.runs_laid[1]) < len(lattices.code_ids):
        size = np.fromiter(map(len, lattices.code_ids), np.int64, len(lattices.code_ids))
        lattices.runs_laid = np.array([i for c in lattices.code_ids for i in c], np.int64), size, np.cumsum(size) - size
    return lattices.runs_laid


def decode_samples(samples: DataFrame, model: str) -> DataFrame:
    """The samples with their decoded text; no ids give an empty text."""

    def decode(batch: pa.RecordBatch) -> pa.RecordBatch:
        lattices = _lattices(model, np.zeros(_processor(model).get_piece_size()), 1.0)
        table = _byte_table(lattices)
        texts = [bytes(decode_ids(np.frombuffer(raw or b"", "<u4").astype(np.int64), table)[0][1:]) for raw in batch.column(batch.schema.get_field_index("ids")).to_pylist()]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array([t.decode(errors="replace") for t in texts], pa.string())], names=[*batch.schema.names, "text"])

    return over_batches(samples, decode, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in samples.schema) + ", text string")
