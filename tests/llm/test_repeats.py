"""Repeat removal against a brute-force walk over all strings, and the run-length index by itself."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from millrace.llm import repeats, run_index
from millrace.llm.run_index import RunIndex


def brute(rows, span):
    """(id, n_bytes, kept) per row."""
    first = {}
    for i, text in rows:
        raw = (text or "").encode()
        for at in range(len(raw) - span + 1):
            g = raw[at : at + span]
            first[g] = min(first.get(g, 2**63), 2**63 - 1 if i is None else i)
    out = []
    for i, text in rows:
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for at in range(len(raw) - span + 1):
            if first[raw[at : at + span]] < (2**63 - 1 if i is None else i):
                gone[at : at + span] = [True] * span
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(raw), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(raw, gone) if not g)).hexdigest()))
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice(["th", "e", "an", "é", "o", "r", "st"]) for _ in range(rng.randint(1, 4)))
    passages = [" ".join(word() for _ in range(rng.randint(8, 60))) for _ in range(12)]
    rows = []
    for i in range(60):
        parts = [" ".join(word() for _ in range(rng.randint(0, 40)))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 2)
            parts += [p[a : a + rng.randint(20, 400)], word()]
        rows.append((i * 3, " ".join(parts)))
    rows += [(7, None), (8, ""), (10, "a" * 700), (11, "b" + "a" * 90), (13, "ab" * 200), (14, "a" * 300), (16, rows[4][1]), (16, rows[4][1]), (None, rows[5][1]), (None, rows[5][1]), (400, "x" * 49), (401, "x" * 49),
             (402, "y" * 50), (403, "y" * 50), (404, rows[9][1] + "\x00" + rows[8][1]), (-5, passages[0] + passages[1])]
    return rows


@pytest.mark.parametrize("span, gram", [(50, 24), (20, 9)])
def test_repeats_match_brute_force(spark, monkeypatch, span, gram):
    monkeypatch.setattr(repeats, "BATCH_BYTES", 1500)
    rows = corpus()
    df = spark.createDataFrame([(t, i, "x") for i, t in rows], "text string, doc_id bigint, batch string").repartition(3)
    got = repeats.repeated_spans(df, span=span, gram=gram).collect()
    mine = sorted(((r["doc_id"], r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest()) for r in got), key=repr)
    assert mine == brute(rows, span)


@pytest.mark.parametrize("limit", [0, 1500])
def test_crowded_keys_match_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(repeats, "BATCH_BYTES", 1500)
    monkeypatch.setattr(repeats, "RANGE_LIMIT", limit, raising=False)
    rows = corpus()
    df = spark.createDataFrame([(t, i) for i, t in rows], "text string, doc_id bigint").repartition(3)
    got = repeats.repeated_spans(df).collect()
    mine = sorted(((r["doc_id"], r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest()) for r in got), key=repr)
    assert mine == brute(rows, 50)


def test_no_range_grows_with_a_phrase_in_every_document(spark, monkeypatch):
    limit = 8000
    monkeypatch.setattr(repeats, "BATCH_BYTES", 4000)
    monkeypatch.setattr(repeats, "RANGE_LIMIT", limit, raising=False)
    rng = random.Random(5)
    noise = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(60))
    line = "the very same line in each of these texts"
    rows = [(i, noise() + line + noise() + ("\n" + noise() * 2 if i % 7 else "")) for i in range(600)]
    rows += [(1000 + i, "copy: " + rows[i][1] + noise()) for i in range(0, 600, 40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    bits = 4
    batches = repeats.cut(repeats._packed(df, "text"))
    answers = repeats._asked(batches, bits, 50, 24, "doc_id", "text")
    size = {}
    for r in repeats._sent(batches, answers, bits, 50, 24, "doc_id", "text").collect():
        if 0 <= r["range"] < 1 << bits:
            size[r["range"]] = size.get(r["range"], 0) + sum(n + 49 for n in r["counts"])
    assert max(size.values(), default=0) <= limit
    got = repeats.repeated_spans(df).collect()
    mine = sorted(((r["doc_id"], r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest()) for r in got), key=repr)
    assert mine == brute(rows, 50)


def test_cut_texts_keep_all_columns(spark):
    said = "é" * 40 + " and more of the same kind of words in here"
    df = spark.createDataFrame([(1, said, "a", 5), (2, "so: " + said, None, 6), (3, None, "c", None)], "doc_id bigint, text string, rows string, size bigint")
    got = {r["doc_id"]: r for r in repeats.without_repeats(df).collect()}
    assert got[1]["text"] == said and got[2]["text"] == "so: " and got[3]["text"] is None
    assert got[2]["size"] == 6 and got[1]["rows"] == "a"
    assert repeats.without_repeats(df.limit(0)).collect() == []


def test_run_index_finds_every_match():
    rng = random.Random(1)
    texts = list({"".join(rng.choice("ab") for _ in range(rng.randint(12, 60))).encode() for _ in range(40)} | {b"a" * 80, b"a" * 111})
    index = RunIndex(np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts]), 12)
    assert index.runs < index.n
    string, offset, row = index.matches()
    first = {}
    for k, t in enumerate(texts):
        for at in range(len(t) - 11):
            first.setdefault(t[at : at + 12], k)
    got = dict(zip(zip(string.tolist(), offset.tolist()), index.first_owner[index.group[row]].tolist()))
    assert got == {(k, at): first[t[at : at + 12]] for k, t in enumerate(texts) for at in range(len(t) - 11)}


@pytest.mark.parametrize("top, block", [(50, 16), (1 << 52, 1024)])  # packed keys, and keys too wide to pack
def test_groups_are_sorted_block_by_block(monkeypatch, top, block):
    monkeypatch.setattr(run_index, "BLOCK", block)
    rng = np.random.default_rng(3)
    opens = np.r_[True, rng.random(499) < 0.1]
    items, by = rng.permutation(500), rng.integers(0, top, 500)
    got, head = run_index._sorted_groups(items, opens, by)
    group = np.cumsum(opens)
    order = np.lexsort((by, group))
    assert (by[np.argsort(items)][got] == by[order]).all()
    assert all(set(got[group == g]) == set(items[group == g]) for g in set(group))
    assert (head == np.r_[True, (by[order][1:] != by[order][:-1]) | (group[1:] != group[:-1])]).all()


def test_only_strings_with_a_window_met_twice_are_indexed():
    rng = random.Random(11)
    shared = bytes(rng.randrange(256) for _ in range(60))
    texts = [bytes(rng.randrange(256) for _ in range(n)) for n in (50, 70, 111, 64)] + [b"x" + shared[:50], shared[:55] + b"yyy", b"ab" * 30, shared[5:55]]
    windows = [[t[a : a + 50] for a in range(len(t) - 49)] for t in texts]
    count = Counter(w for own in windows for w in own)
    got = repeats._met(np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts]), 50)
    assert got.tolist() == [any(count[w] > 1 for w in own) for own in windows] and 0 < got.sum() < len(texts)


def test_segments_end_with_their_documents():
    rng = np.random.default_rng(3)
    lengths = np.array([0, 120, 49, 50, 0, 300, 10, 200, 0])
    data = rng.integers(97, 99, int(lengths.sum())).astype(np.uint8)
    keys, doc, first, count = repeats.segments(data, lengths, 50, 24)
    starts = np.cumsum(lengths) - lengths
    got = {(d, w): k for k, d, f, c in zip(keys.tolist(), doc.tolist(), first.tolist(), count.tolist()) for w in range(f, f + c)}
    assert sorted(got) == [(d, w) for d, (s, n) in enumerate(zip(starts.tolist(), lengths.tolist())) for w in range(s, s + n - 49)]
    least = {w: repeats.gram_hashes(data[w : w + 50], 24).min() for _, w in got}
    assert all((got[a] == got[b]) == (least[a[1]] == least[b[1]]) for a in got for b in got if a[1] < b[1] < a[1] + 4)
