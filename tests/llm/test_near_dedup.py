"""Near-duplicate classes against all pairs, also where a bucket's leader is linked with nobody."""

import random

import pytest

from millrace.llm import near_dedup
from millrace.llm.near_dedup import alive_pairs, common_counts, hash_family, least_matches, signature
from millrace.llm.texts import shingle_set

import numpy as np


def brute(rows, size, percent):
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        s = {b" ".join(w[k : k + size]) for k in range(max(len(w) - size + 1, 1))} if w else set()
        sets[i] = s
    ids = sorted(sets)
    comp = {i: i for i in ids}
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    moved = True
    while moved:
        moved = False
        for a, b in links:
            low = min(comp[a], comp[b])
            moved |= comp[a] != low or comp[b] != low
            comp[a] = comp[b] = low
    return {i: (len(sets[i]), comp[i]) for i in ids}


def near_copies(rng, base, edits):
    out = list(base)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return " ".join(out)


def corpus():
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(400)}"
    rows = [(i, " ".join(word() for _ in range(rng.randint(0, 60)))) for i in range(40)]
    for group in range(4):
        base = [word() for _ in range(120)]
        rows += [(100 * (group + 1) + i, near_copies(rng, base, rng.choice([0, 1, 2, 3, 5, 8]))) for i in range(30)]
    rows += [(900, rows[50][1].upper()), (901, None), (902, ""), (903, "one two"), (904, "One \t two\n"), (905, " "), (906, " ")]
    return rows


@pytest.mark.parametrize("block", [256, 7])
def test_classes_match_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rows = corpus()
    df = spark.createDataFrame([(t, i, 1) for i, t in rows], "text string, doc_id bigint, component int")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(df, shingle_words=4).collect()}
    assert got == brute(rows, 4, 80)


def test_blocks_alone_find_all_links(spark, monkeypatch):
    """Without further star rounds the blocks have to find everything that the first leader leaves."""
    monkeypatch.setattr(near_dedup, "BLOCK", 5)
    monkeypatch.setattr(near_dedup, "STAR_ROUNDS", 1)
    rows = corpus()
    df = spark.createDataFrame([(t, i) for i, t in rows], "text string, doc_id bigint")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(df, shingle_words=4).collect()}
    assert got == brute(rows, 4, 80)


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, "x"), (2, "A b c d e f"), (3, None)], "doc_id bigint, text string")
    got = sorted(near_dedup.near_duplicates(df).collect(), key=repr)
    assert [(r["doc_id"], r["component_id"], r["kept"]) for r in got] == [(1, 1, True), (2, 1, False), (3, 3, True), (None, None, True), (None, None, True)]
    kept = near_dedup.keep_one_of_each(df.withColumn("component", df["doc_id"]))
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 0, 1, 3] and kept.columns == ["doc_id", "text", "component"]
    assert near_dedup.near_duplicates(df.limit(0)).collect() == []


def test_posterior_bounds():
    least = least_matches(128, 32, 80, 1e-6)
    assert least == sorted(least) and 0 < least[0] < 26 and least[-1] > 64
    one, other = np.zeros((3, 128), np.int32), np.zeros((3, 128), np.int32)
    other[1, :] = 1
    other[2, 100:] = 1
    assert alive_pairs(one, other, 32, least).tolist() == [0, 2]


def test_signatures_estimate_similarity():
    family = hash_family(512, 3)
    a = shingle_set(" ".join(f"a{i}" for i in range(600)).encode(), 5)
    b = shingle_set(" ".join(f"a{i}" for i in range(150, 750)).encode(), 5)
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((signature(a, family) == signature(b, family)).mean() - true) < 0.08


def test_common_counts():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 500, rng.integers(1, 300)).astype(np.uint64)) for _ in range(20)]
    want = [[len(np.intersect1d(a, b)) for b in sets[12:]] for a in sets[:12]]
    assert common_counts(sets[:12], sets[12:], width=37).tolist() == want


def test_large_group_sends_few_rows(spark, monkeypatch):
    """One large component and some members outside it: rows grow with the members, not with their square."""
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    monkeypatch.setattr(near_dedup, "CHUNK", 32)
    n, minor = 2000, 6
    mixed = spark.range(n).selectExpr("0 as turn", "7L as band", "id as doc_id", f"if(id < {minor}, id, {minor}L) as component", f"{n}L as n")
    pool = spark.range(n).selectExpr("id as doc_id", "100L as bytes")
    rows = near_dedup._block_rows(mixed, pool).collect()
    assert len(rows) <= n + minor * (1 + n // 32 + 1)
    tasks = {}
    for r in rows:
        tasks.setdefault((r["kind"], r["lo"], r["hi"]), []).append(r)
    met = {(a["doc_id"], b["doc_id"]) for (kind, lo, hi), held in tasks.items() for a in held if a["minor"] for b in held if a["doc_id"] != b["doc_id"]}
    assert met == {(a, b) for a in range(minor) for b in range(n) if a != b}


def test_rows_that_share_an_id_keep_the_smallest_text(spark):
    df = spark.createDataFrame([(5, "b text", 1), (5, "a text", 2), (6, None, 3), (6, "x", 4), (5, "a text", 2)], "doc_id bigint, text string, n int")
    for parts in (1, 4):
        got = near_dedup.keep_one_of_each(df.repartition(parts))
        assert sorted(tuple(r) for r in got.collect()) == [(5, "a text", 2), (6, None, 3)] and got.columns == df.columns
