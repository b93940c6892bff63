"""Token counts, token files and sampled segmentations."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm import segment_sampling, token_counts, token_files
from millrace.llm.byte_bpe import WholeTexts
from millrace.llm.segment_sampling import Lattices, chunks, cut_gumbel, sample_words

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", " ", "Hello there, it's 1 2 34!", "a  b   c \n\n d\t e ", " lead", "trail ", "x\x1c y \x85 z", "naïve 日本語 🎉 e\u0301 ", "don't\u00a0stop 's", "<|endoftext|> a <|endoftext|>b", "a <|endoftext|>", "\n a", "1 000 000", "▁ a▁b"]


def test_whole_texts_give_the_library_tokens():
    whole, encoder = Tokenizer.from_file(BYTES), WholeTexts(BYTES)
    rng = random.Random(1)
    pool = " \n\tab'sé日1,.\u00a0\x1c"
    for text in TEXTS + ["".join(rng.choice(pool) for _ in range(rng.randint(0, 40))) for _ in range(400)]:
        want = whole.encode(text, add_special_tokens=False)
        got = encoder.tokens(text)
        assert got[0].tolist() == want.ids and list(zip(got[1].tolist(), got[2].tolist())) == want.offsets, repr(text)


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_attribution(spark, rule):
    rng = random.Random(2)
    rows = []
    for i, text in enumerate(TEXTS * 2):
        cuts = sorted(rng.randint(0, len(text)) for _ in range(4))
        rows.append((text, i, [(7, cuts[0], cuts[1]), (3, cuts[2], cuts[3]), (5, cuts[0], cuts[0])], 1))
    rows += [(None, 900, [], 1), ("some text", None, None, 1), ("some text", 901, [(1, 0, 4)], 1)]
    df = spark.createDataFrame(rows, "text string, doc_id bigint, sections array<struct<section:bigint,start:bigint,end:bigint>>, section int")
    got = {(r["doc_id"], r["section"]): r["n_tokens"] for r in token_counts.section_tokens(df, BYTES, rule, sections_col="sections").collect()}
    whole = Tokenizer.from_file(BYTES)
    for text, i, sections, _ in rows:
        want, outside = Counter({s[0]: 0 for s in sections or ()}), 0
        for start, end in whole.encode(text or "", add_special_tokens=False).offsets:
            if rule == "first":
                hit = [(s[0], 1) for s in sections or () if s[1] <= start < s[2]]
            else:
                over = [(min(end, s[2]) - max(start, s[1]), s[0]) for s in sections or () if min(end, s[2]) > max(start, s[1])]
                hit = [(n, o / (end - start)) for o, n in over] if rule == "share" else [(max(over, key=lambda x: x[0])[1], 1)] if over else []
            for name, n in hit:
                want[name] += n
            outside += 1 - sum(n for _, n in hit)
        for name, n in want.items():
            assert got[i, name] == pytest.approx(n)
        assert got[i, None] == pytest.approx(outside)


def test_lines_are_the_default_sections(spark):
    df = spark.createDataFrame([(1, "one two\nthree\n"), (2, None)], "doc_id bigint, text string")
    got = {(r["doc_id"], r["section"]): r["n_tokens"] for r in token_counts.section_tokens(df, BYTES).collect()}
    assert got == {(1, 0): 2, (1, 1): 1, (1, 2): 0, (1, None): 2, (2, None): 0}


def test_code_lengths_are_optimal_within_the_limit():
    rng = np.random.default_rng(3)
    for n, limit in [(1, 4), (2, 4), (5, 3), (9, 4), (40, 6), (300, 9), (17, 4)]:
        counts = rng.integers(1, 2 ** rng.integers(1, 20, n))
        bits = token_files.code_lengths(counts, limit)
        assert bits.max() <= max(limit, (n - 1).bit_length(), 1) and sum(2.0**-b for b in bits) <= 1
        if n in (5, 9):  # by brute force over all length profiles
            best = min(sum(c * b for c, b in zip(sorted(counts, reverse=True), profile)) for profile in itertools.combinations_with_replacement(range(1, limit + 1), n)
                       if sum(2.0**-b for b in profile) <= 1)
            assert (counts * bits).sum() == best


def test_blocks_round_trip():
    rng = np.random.default_rng(4)
    ids = np.minimum(rng.geometric(0.02, 5000), 400).astype(np.int64) * 3
    names, counts = np.unique(ids, return_counts=True)
    coder = token_files.Coder(names, token_files.code_lengths(counts))
    for n in (0, 1, 255, 256, 257, 5000):
        payload, offsets = coder.encode(ids[:n])
        assert coder.decode(payload, offsets, n).tolist() == ids[:n].tolist()


def test_token_files(spark, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 40)
    rows = [(i * 7 % 101, t) for i, t in enumerate(TEXTS * 5)] + [(500, None), (500, "twice"), (500, "twice")]
    df = spark.createDataFrame([(t, i, 0) for i, t in rows], "text string, doc_id bigint, start int")
    got = sorted(tuple(r) for r in token_files.token_file_digest(df, BYTES).select("start", "doc_id", "n_tokens", "ids_crc32").collect())
    whole, at, want = Tokenizer.from_file(BYTES), 0, []
    for i, text in sorted(rows, key=lambda r: (r[0], r[1] is not None, (r[1] or "").encode())):
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 0]
        want.append((at, i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want
    assert token_files.token_file_digest(df.limit(0), BYTES).collect() == []


def all_paths(lattices, name):
    """{ids: probability} of every segmentation of one chunk."""
    laid = lattices.of_names([name])
    out = {}

    def go(place, p, ids):
        if place == laid["size"][0]:
            out[tuple(ids)] = p
            return
        edge = int(laid["first"][place])
        while True:
            go(place + int(laid["step"][edge]), p * math.exp(laid["log"][edge]), ids + [int(laid["code"][edge])])
            if laid["cumulated"][edge] >= 2:
                return
            edge += 1

    go(0, 1.0, [])
    return out


def test_samples_are_distinct_and_follow_the_model():
    logs = np.log(np.random.default_rng(5).dirichlet(np.ones(32000)))
    lattices = Lattices(PIECES, logs, 1.0)
    words = ["▁the", "▁an", "\n"]
    laid = lattices.of_names(words)
    n = 6000
    kind = np.tile(np.arange(3), n)
    *ranks, last = sample_words(laid, kind, np.full(n, 3), np.arange(n).astype(np.uint64), 4)
    singles = [all_paths(lattices, w) for w in words]
    product = {a + b + c: singles[0][a] * singles[1][b] * singles[2][c] for a in singles[0] for b in singles[1] for c in singles[2]}
    assert sum(product.values()) == pytest.approx(1)
    drawn = [[] for _ in range(n)]
    for found in ranks:
        codes = laid["code"][found["edges"]]
        ends = np.cumsum(np.add.reduceat(found["counts"], np.arange(0, 3 * n, 3)))
        for d in found["docs"].tolist():
            path = tuple(codes[ends[d] - (ends[d] - (ends[d - 1] if d else 0)) : ends[d]].tolist())
            assert found["log"][d] == pytest.approx(math.log(product[path]))
            drawn[d].append(path)
    assert all(len(set(d)) == len(d) for d in drawn)
    first = Counter(d[0] for d in drawn)
    second = Counter(d[1] for d in drawn)
    for path, p in product.items():
        assert abs(first[path] / n - p) < 4.5 * math.sqrt(p * (1 - p) / n) + 1e-3
        q = sum(product[o] * p / (1 - product[o]) for o in product if o != path)
        assert abs(second[path] / n - q) < 4.5 * math.sqrt(q * (1 - q) / n) + 1e-3
    for one, two in zip(ranks, ranks[1:]):
        both = np.intersect1d(one["docs"], two["docs"])
        assert (one["score"][both] >= two["score"][both]).all() and (two["score"][both] >= last["left"][both]).all()


def test_all_segmentations_are_found_when_few():
    lattices = Lattices(PIECES, np.full(32000, -math.log(32000)), 6.0)
    name = "▁the"
    laid, paths = lattices.of_names([name]), all_paths(lattices, name)
    *ranks, last = sample_words(laid, np.zeros(1, np.int64), np.ones(1, np.int64), np.array([9], np.uint64), len(paths) + 3)
    found = [tuple(laid["code"][r["edges"]].tolist()) for r in ranks if len(r["docs"])]
    assert sorted(found) == sorted(paths) and last["left"][0] == -np.inf


@pytest.mark.parametrize("name", ["▁the", "▁king", "▁house"])
def test_improbable_segmentations_are_found(name):
    """One piece has all but 1e-30 of the probability; the others still come, each once."""
    processor = segment_sampling._processor(PIECES)
    logs = np.full(32000, -80.0)
    logs[processor.piece_to_id(name)] = 0.0
    lattices = Lattices(PIECES, logs, 1.0)
    laid, paths = lattices.of_names([name]), all_paths(lattices, name)
    assert len(paths) >= 8
    for k in (3, len(paths) - 1, len(paths), len(paths) + 2):
        *ranks, last = sample_words(laid, np.zeros(4, np.int64), np.ones(4, np.int64), np.arange(4, dtype=np.uint64), k)
        for doc in range(4):
            found = []
            for r in ranks:
                here = np.repeat(np.arange(4), r["counts"]) == doc
                if doc in r["docs"]:
                    found.append(tuple(laid["code"][r["edges"][here]].tolist()))
            assert len(set(found)) == len(found) == min(k, len(paths)) and set(found) <= set(paths)
        assert np.isfinite(last["left"]).all() == (k < len(paths))


def test_mass_of_what_is_not_barred():
    logs = np.log(np.random.default_rng(6).dirichlet(np.ones(32000)))
    lattices = Lattices(PIECES, logs, 1.0)
    laid = lattices.of_names(["▁the"])
    paths = {}
    for seed in range(400):
        edges, _, log = segment_sampling.walk(laid, np.zeros(1, np.int64), np.array([seed * 977], np.uint64))
        paths[tuple(edges.tolist())] = math.exp(log[0])
    some = sorted(paths)[:3]
    assert math.exp(segment_sampling.Barred(laid, some).rest[0]) == pytest.approx(1 - sum(paths[p] for p in some))
    drawn = Counter(segment_sampling.other_path(laid, 0, some, i * 7919)[0] for i in range(4000))
    assert not set(drawn) & set(some)
    for path, p in paths.items():
        if path not in some:
            q = p / (1 - sum(paths[s] for s in some))
            assert abs(drawn[path] / 4000 - q) < 4.5 * math.sqrt(q * (1 - q) / 4000) + 1e-3


def test_cut_gumbel_stays_below():
    u = np.random.default_rng(1).random(10000)
    got = cut_gumbel(np.full(10000, -3.0), np.full(10000, -2.5), u)
    assert got.max() <= -2.5 and abs(np.mean(got < -3.0) - math.exp(-1) / math.exp(-math.exp(-0.5))) < 0.02


def test_sampling_texts(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(1, TEXTS[2]), (1, TEXTS[2]), (None, "null id"), (60, None), (61, "x" * 3000 + " " + "word " * 2000)]
    df = spark.createDataFrame([(t, i, 0) for i, t in rows], "text string, doc_id bigint, rank int").repartition(3)
    samples = segment_sampling.sample_segmentations(df, PIECES, k=3, seed=4)
    got = [r.asDict() for r in samples.collect()]
    assert all(r["exact"] for r in got if r["doc_id"] != TEXTS.index("▁ a▁b"))
    again = {(r["doc_id"], r["rank"], bytes(r["ids"])) for r in segment_sampling.sample_segmentations(df.repartition(1), PIECES, k=3, seed=4).collect()}
    assert again == {(r["doc_id"], r["rank"], bytes(r["ids"])) for r in got}
    per = Counter(r["doc_id"] for r in got)
    assert per[0] == per[60] == 1 and per[61] == 3 and all(0 < r["inclusion"] <= 1 or r["inclusion"] == 0 for r in got)
    assert len({bytes(r["ids"]) for r in got if r["doc_id"] == 61}) == 3
    texts = {r["text"] for r in segment_sampling.decode_samples(samples.where("doc_id = 7"), PIECES).collect()}
    assert texts == {TEXTS[7]}
    assert segment_sampling.sample_segmentations(df.limit(0), PIECES).collect() == []
    pair = spark.createDataFrame([(None, "the house"), (None, "the king"), (None, "the house")], "doc_id bigint, text string")
    scores = [r["score"] for r in segment_sampling.sample_segmentations(pair, PIECES, k=1, logs=np.full(32000, -math.log(32000))).collect()]
    assert len(scores) == 3 and len(set(scores)) == 2  # rows are keyed by their texts too


def test_only_words_behind_the_divergence_are_drawn(monkeypatch):
    drawn, walk = [], segment_sampling.walk
    monkeypatch.setattr(segment_sampling, "walk", lambda laid, kind, key: drawn.append(len(kind)) or walk(laid, kind, key))
    lattices = Lattices(PIECES, np.full(32000, -math.log(32000)), 1.0)
    texts = ["several ordinary words that are told apart"] * 20
    points, starts, sizes = lattices.split(texts)
    laid, kind = lattices.known(points, starts)
    sample_words(laid, kind, sizes, np.arange(1, 21, dtype=np.uint64), 3)
    assert drawn[0] == len(kind) and max(drawn[1:]) < 0.8 * len(kind)


def test_chunks_are_counted_by_their_words(spark):
    texts = ["a b\nc", " a", "a  b", "a \n b ", "\n\na\n", "a▁b c", " ", "\n", "\tx \u00a0y", "", None]
    want = Counter(i for t in texts if t for i in segment_sampling._processor(PIECES).encode(t))
    got = {r["piece"]: r["n"] for r in segment_sampling.piece_counts(spark.createDataFrame([(t,) for t in texts], "text string"), PIECES).collect()}
    assert got == want


def test_trained_counts_equal_the_models_own_encoding(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = [t for t in TEXTS if "▁" not in t] + ["one two\nthree  four \n\n five", "a\n b\n", "\n", "  "]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "text string")
    got = {r["piece"]: r["n"] for r in segment_sampling.piece_counts(df, PIECES).collect()}
    assert got == Counter(i for t in texts for i in sp.encode(t))
    assert all("".join(chunks(t)) == "▁" + t.replace(" ", "▁") for t in texts if t)


def test_cuts_lose_no_segmentation():
    """The chain of cut chunks has as many segmentations as the whole text, counted piece by piece."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    pieces = {sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
    lattices = Lattices(PIECES, np.full(32000, -math.log(32000)), 1.0)
    for text in [t for t in TEXTS if t] + ["the.\nThe, (x)!! 12:30 naïvely"]:
        whole = "▁" + text.replace(" ", "▁")
        ways = [1] + [0] * len(whole)
        for end in range(1, len(whole) + 1):
            ways[end] = sum(ways[a] for a in range(max(0, end - 16), end) if whole[a:end] in pieces or end - a == 1)
        points, starts, sizes = lattices.split([text])
        assert "".join(map(chr, points)) == whole and sizes.tolist() == [len(starts)]
        product = 1
        for a, b in zip(starts, [*starts[1:], len(whole)]):
            product *= len(all_paths(lattices, whole[a:b])) if b - a < 14 else ways_of(whole[a:b], pieces)
        assert product == ways[-1]


def ways_of(text, pieces):
    ways = [1] + [0] * len(text)
    for end in range(1, len(text) + 1):
        ways[end] = sum(ways[a] for a in range(max(0, end - 16), end) if text[a:end] in pieces or end - a == 1)
    return ways[-1]


def test_a_worker_keeps_lattices_in_bounded_memory():
    lattices = Lattices(PIECES, np.full(32000, -math.log(32000)), 1.0)
    lattices.known(*lattices.split(["some words to lay out"])[:2])
    per_edge = sum(lattices.laid[k].itemsize for k in ("cumulated", "log", "of", "step", "code"))
    assert per_edge * segment_sampling.KEPT_EDGES <= 64 << 20
