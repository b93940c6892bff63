"""Packing, the conversation trie and the alignment of two tokenizers, against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import alignment, packing, prefix_trie
from millrace.llm.byte_bpe import WholeTexts

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", " ", "Hello there, it's 1 2 34!", "a  b   c \n\n d\t e ", " lead", "trail ", "x\x1c y \x85 z", "naïve 日本語 🎉 é ", "don't stop 's", "<|endoftext|> a <|endoftext|>b",
         "</s> <s> ▁x", "▁ a", "1 000 000", "word " * 900, "x" * 3000, "é" * 700 + "日本" * 500, "same text", "same text"]


def test_whole_texts_have_the_library_ids():
    rng = random.Random(1)
    pool = " \n\tab'sé日1,. \x1c Z<|endoftext|>"
    texts = TEXTS + ["".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(500)] + ["<|endoftext|>" * 3 + " a", " " * 1_200_000 + "a"]
    library = Tokenizer.from_file(BYTES)
    for plain in (False, True):
        library.encode_special_tokens = plain
        encoder = WholeTexts(BYTES, plain)
        assert encoder.ranks is not None
        for text in texts:
            assert encoder.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids
    assert encoder.ids(None).tolist() == []


def test_other_tokenizers_go_to_the_library():
    other = WholeTexts(public_tokenizers.path("word_bpe_49k.json"))
    assert other.ranks is None
    assert other.ids("Some Words").tolist() == Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode("Some Words", add_special_tokens=False).ids


def test_windows_are_full_and_balanced():
    rng = np.random.default_rng(2)
    for n in (1, 2, 30, 400):
        lengths = rng.integers(1, 64, n)
        pieces, size, cost = packing.balanced(lengths, 64, 1.0, 1 / 64)
        assert size.sum() == lengths.sum() and all(s & (s - 1) == 0 for s in size)
        held, used = defaultdict(list), np.zeros(len(size), np.int64)
        rising = [0.0] * len(size)
        room, order = size.copy(), [p[0] for p in pieces]
        assert [lengths[i] for i in dict.fromkeys(order)] == sorted(lengths, reverse=True)
        for item, start, length, at, offset in pieces:
            left = lengths[item] - start
            fits = [k for k in range(len(size)) if room[k] >= left] or [k for k in range(len(size)) if room[k]]
            assert at == min(fits, key=lambda k: (rising[k], k)) and offset == used[at] and start == sum(held[item])
            held[item].append(length)
            used[at] += length
            room[at] -= length
            rising[at] += length + length * length / 64
        assert (room == 0).all() and [sum(held[i]) for i in range(n)] == lengths.tolist() and cost == pytest.approx(rising)


@pytest.mark.parametrize("window", [3, 8192])
def test_packing(spark, monkeypatch, window):
    monkeypatch.setattr(packing, "WINDOW", window)
    rows = [(t, i, "x") for i, t in enumerate(TEXTS)] + [(None, 90, "x"), ("null id", None, "x"), ("same row", 91, "x"), ("same row", 91, "x")]
    df = spark.createDataFrame(rows, "text string, doc_id bigint, offset string").repartition(3)
    got = packing.pack_documents(df, BYTES, capacity=256).collect()
    library = Tokenizer.from_file(BYTES)
    want = Counter((i, np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes()) for t, i, _ in rows)
    documents, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        assert len(r["ids"]) == 4 * r["length"] and r["length"] > 0
        documents[r["doc_id"], r["doc_tokens"]].append((r["start"], bytes(r["ids"])))
        sequences[r["sequence_id"]].append((r["offset"], r["length"], r["sequence_tokens"]))
    have = Counter()
    for (i, n), pieces in documents.items():
        copies = sum(1 for start, _ in pieces if start == 0)
        assert sum(len(b) for _, b in pieces) == 4 * n * copies
        laid = bytearray(4 * n)
        for start, raw in pieces:
            laid[4 * start : 4 * start + len(raw)] = raw
        have[i, bytes(laid)] += copies
    assert have == want
    for parts in sequences.values():
        at = 0
        for offset, length, size in sorted(parts):
            assert offset == at
            at += length
        assert at == size and size & (size - 1) == 0 and size <= 256
    assert packing.pack_documents(df.limit(0), BYTES).collect() == []


def brute_trie(rows):
    """The contract, conversation by conversation."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(turns.get(c - c % 20, [])[:h] + turns[c][h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, seq in rebuilt.items():
        ends[seq].append(c)
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    out = set()
    for key, who in members.items():
        below = [k for k in members if k[: len(key)] == key]
        saved = sum((len(members[k]) - 1) * len(k[-1][1].encode().split()) for k in below if k)
        leaves = sum(1 for k in below if not any(len(o) == len(k) + 1 and o[:-1] == k for o in members))
        children = sum(1 for o in members if len(o) == len(key) + 1 and o[:-1] == key)
        text = ",".join(map(str, sorted(ends.get(key, []))))
        out.add((min(who), len(key), min(members[key[:-1]]) if key else None, len(who), children, leaves, saved, hashlib.sha256(text.encode()).hexdigest()))
    return out


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.mark.parametrize("carried", [4096, 5])
def test_trie(spark, monkeypatch, carried):
    monkeypatch.setattr(prefix_trie, "CARRIED", carried)
    rng = random.Random(3)
    rows = []
    for c in [*range(40), 100, 101, 102, 119, 7000]:
        if c == 20:  # no base conversation for its group
            continue
        rows += [(c, t, rng.choice(["user", "assistant"]), rng.choice(["a b", "a c d", ""])) for t in range(rng.randint(1, 6))]
    long = [(rng.choice("ab"), f"turn {i}") for i in range(70)]  # many turns, near copies that leave at different depths
    for c, n in ((205, 70), (206, 70), (207, 41), (208, 70), (209, 13)):
        rows += [(c, i, *(long[i] if i < n - 1 else ("user", f"last {c}"))) for i in range(n)]
    rows += [(300 + i, 0, "user", "copy") for i in range(9)] + [(400, None, None, None), (400, None, "user", "x"), (400, 1, "user", None), (400, 1, "user", None), (None, 1, "user", "nobody")]
    df = spark.createDataFrame([(t, c, r, x, 0) for c, t, r, x in rows], "turn bigint, conv_id bigint, role string, text string, depth int").repartition(4)
    got = [tuple(r[c] for c in COLUMNS) for r in prefix_trie.prefix_trie(df).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_trie(rows)
    assert prefix_trie.prefix_trie(df.limit(0)).collect() == []


def test_fattest(spark):
    rows = [(a, b) for a in range(70) for b in range(a + 1, 140)]
    got = spark.createDataFrame(rows, "a bigint, b bigint").select("a", "b", prefix_trie.fattest(F.col("a"), F.col("b")).alias("f")).collect()
    for r in got:
        assert r["f"] == max(range(r["a"] + 1, r["b"] + 1), key=lambda n: n & -n)


def test_merge_path_finds_common_ends():
    rng = np.random.default_rng(4)
    for _ in range(400):
        a, b = (np.unique(rng.integers(1, 25, rng.integers(0, 15))) for _ in range(2))
        for piece in (1, 2, 3, 7, 100):
            at_a, at_b = alignment.common_ends(a, b, piece)
            want = np.intersect1d(a, b)
            assert a[at_a].tolist() == want.tolist() and b[at_b].tolist() == want.tolist()
    diagonals = np.arange(0, 31, 5)
    a, b = np.arange(0, 30, 2), np.arange(1, 30, 2)
    assert (np.diff(alignment.crossings(a, b, diagonals)) <= 5).all()


def test_wide_groups_are_counted_by_ids(monkeypatch):
    rng = np.random.default_rng(5)
    ids_a, ids_b = rng.integers(0, 4, 60), rng.integers(0, 5, 50)
    last_a, last_b, doc = np.array([0, 30, 40, 59]), np.array([3, 20, 21, 49]), np.array([0, 0, 1, 2])
    whole = alignment.linked_pairs(ids_a, ids_b, doc, last_a, last_b, 5)
    monkeypatch.setattr(alignment, "LINKS", 40)
    assert all((x == y).all() for x, y in zip(whole, alignment.linked_pairs(ids_a, ids_b, doc, last_a, last_b, 5)))


def brute_groups(text, library, model, table_a, table_b):
    if not text:
        return None
    raw = (" " + text).encode()
    ids_a, ids_b = library.encode(" " + text, add_special_tokens=False).ids, model.encode(text)
    if b"".join(table_a[i] for i in ids_a) != raw or b"".join(table_b[i] for i in ids_b) != raw:
        return None
    ends_a, ends_b = (np.cumsum([len(t[i]) for i in ids]).tolist() for t, ids in ((table_a, ids_a), (table_b, ids_b)))
    groups, a, b = [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        to_a, to_b = ends_a.index(end) + 1, ends_b.index(end) + 1
        groups.append((ids_a[a:to_a], ids_b[b:to_b]))
        a, b = to_a, to_b
    return groups


@pytest.mark.parametrize("pairs", [40, 1_000_000])
def test_alignment(spark, monkeypatch, pairs):
    import sentencepiece

    monkeypatch.setattr(alignment, "BLOCK_PAIRS", pairs)
    monkeypatch.setattr(alignment, "PIECE", 7)
    rows = [(t, i, 0) for i, t in enumerate(TEXTS)] + [(None, 90, 0), ("null id", None, 0), ("same row", 91, 0), ("same row", 91, 0)]
    df = spark.createDataFrame(rows, "text string, doc_id bigint, n_a int").repartition(3)
    library, model = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    library.encode_special_tokens = True
    table_a, table_b = WholeTexts(BYTES).bytes, alignment.Pieces(PIECES).bytes
    groups = [brute_groups(t, library, model, table_a, table_b) for t, _, _ in rows]
    links = [Counter((a, b) for ga, gb in g or () for a in ga for b in gb) for g in groups]
    counts = Counter(pair for one in links for pair in one)
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    want = []
    for (_, i, _), g, one in zip(rows, groups, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g or ())
        want.append((i, sum(len(a) for a, _ in g or ()), sum(len(b) for _, b in g or ()), len(g or ()), sum(one.values()), sum(m for p, m in one.items() if counts[p] == most[p[0]]),
                     sum(m * counts[p] for p, m in one.items()), hashlib.sha256(text.encode()).hexdigest() if g else ""))
    found, table = alignment.align(df, BYTES, PIECES)
    got = [tuple(r[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {(r["a"], r["b"]): (r["n"], r["best"]) for r in table.collect()} == {p: (n, n == most[p[0]]) for p, n in counts.items()}
    empty = alignment.align(df.limit(0), BYTES, PIECES)
    assert empty[0].collect() == [] and empty[1].collect() == []
