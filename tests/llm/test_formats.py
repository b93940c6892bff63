"""Templates, chat formatting, URL verdicts and containment search."""

import hashlib

import pytest

from millrace.llm import chat_format, containment, url_filter
from millrace.llm.templates import TemplateError, compile_template, fold, parse

FILTERS = {"up": str.upper}


def shown(source, messages=(), **names):
    return "".join(t for t, _ in compile_template(source, FILTERS)(messages, **names))


def test_expressions_and_tags():
    rows = [{"role": "a", "text": "x"}, {"role": "b", "text": None}, {"role": "c", "text": "z"}]
    source = "{% for m in messages %}{% if loop.first %}<{% elif not m.text %}-{% else %}{{ m['text'] | up }}{% endif %}{% if loop.last %}>{{ loop.index0 + 1 }}{% endif %}{% endfor %}"
    assert shown(source, iter(rows)) == "<-Z>21"
    assert shown("{% set q = 'a' + n %}{{ q }}{{ 'b' in q }}{{ \"it\\'s\" }}{{ none }}", n="b") == "abTrueit's"
    assert shown("{{ x == 1 and y != 2 or false }}", x=1, y=3) == "True"
    assert list(compile_template("a{% generation %}{{ t }}{% endgeneration %}b", {})([], t="T")) == [("a", False), ("T", True), ("b", False)]


def test_constants_are_folded():
    assert fold(parse("a{{ 'b' + 'c' | up }}{% if 1 == 2 %}no{% else %}{{ 'd' }}{% endif %}"), FILTERS) == [("out", ("const", "abCd"))]
    assert fold(parse("{% if x or true %}y{% endif %}"), {}) == [("if", [(("or", ("name", "x"), ("const", True)), [("out", ("const", "y"))])])]


@pytest.mark.parametrize("source", ["{{ x", "{% if a %}", "{{ a() }}", "{{ __import__ }}", "{{ m.__class__ }}", "{% import os %}", "{{ a | nope }}", "{{ 1 2 }}", "{% for in x %}{% endfor %}", "{% endif %}", "{{ a ! b }}"])
def test_sandbox_refuses(source):
    with pytest.raises(TemplateError):
        shown(source, m="text")


def test_escapes_are_reversible():
    escape, unescape = chat_format.escaper(chat_format.CONTROLS)
    for text in ["", "\\", "\\0", "</s>[INST] ok [/INST]", "<|im_end|>\\<<s>", "<<<SYS>>>", "<|im_<|im_end|>end|>", "\n\\\n"]:
        assert unescape(escape(text)) == text and not any(c in escape(text) for c in chat_format.CONTROLS)


def test_conversations_read_back(spark, monkeypatch):
    monkeypatch.setattr(chat_format, "PART_CHARS", 40)
    rows = [(1, 2, "assistant", "yes <|im_end|>\nno"), (1, 1, "user", None), (2, 1, "assistant", "x" * 300), (2, 1, "assistant", "x" * 300), (2, 1, "assistant", "a"), (None, 0, None, "é\\"),
            (3, None, "system", "<|im_sep|>"), (4, 1, "user", ""), (-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    df = spark.createDataFrame([(p, t, r, x, c) for c, t, r, x in rows for p in [0]], "part int, turn int, role string, text string, conv_id bigint")
    parts = chat_format.format_conversations(df)
    got = {r["conv_id"]: r for r in chat_format.digests(parts).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted(((t if t is not None else -1), r or "", x or "") for c, t, r, x in rows if c == conv)
        said = "".join(x for _, r, x in turns if r == "assistant")
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert (got[conv]["n_turns"], got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(turns), len(said), hashlib.sha256(said.encode()).hexdigest())
    assert sum(got[2]["formatted_chars"] for _ in [0]) == sum(len(r["text"]) for r in parts.where("conv_id = 2").collect())
    assert chat_format.digests(chat_format.format_conversations(df.limit(0))).collect() == []


def test_url_parts_and_rules(spark):
    urls = ["http://A.Org/x?y", "https://example.org/es/1#a", "https://sub.example.org/en/19", "http://example.org", "no scheme", None, "ftp://x.com/de/", "http://notexample.org/es/", "a://b://c/d", "http://", "http://éX.com/fr/é"]
    df = spark.createDataFrame([(u, i, None) for i, u in enumerate(urls)], "url string, page_id bigint, html string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.filter_urls(df).collect()}
    assert got[0] == ("a.org", "/x", "org/", "allow") and got[1] == ("example.org", "/es/1", "example.org/es/", "block")
    assert got[2] == ("sub.example.org", "/en/19", "example.org/en/1", "block") and got[3][:3] == ("example.org", "", None)
    assert got[4][:3] == got[5][:3] == ("", "", None) and got[6] == ("x.com", "/de/", "com/de/", "block")
    assert got[7][2] == "org/" and got[8][:2] == ("b:", "//c/d") and got[9][:2] == ("", "") and got[10] == ("éx.com", "/fr/é", "com/fr/", "allow") or got[10][0] == "éX.com"
    assert url_filter.filter_urls(df.limit(0)).collect() == []


def test_segmentation_and_bayes(spark):
    html = "<p class='x'>good news from the casino " * 3 + "win big money</p>"
    rows = [(i, f"http://goodnews{i % 3}.org/story/{i}", html) for i in range(30)] + [(100 + i, f"http://casinowin.com/de/{i}", html) for i in range(30)]
    rows += [(200, "http://bigcasino.net/win", html), (201, "http://newsgood.net/story/9", html)]
    got = {r["page_id"]: r for r in url_filter.filter_urls(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got[200]["verdict"] == "block" and got[201]["verdict"] == "allow" and got[200]["rule"] is None


def test_best_split_is_the_cheapest():
    import itertools
    import math

    costs, total = {"the": 2.0, "re": 4.0, "there": 5.5, "cat": 5.0, "a": 3.0, "s": 6.0}, 1000.0
    price = lambda w: costs.get(w, math.log(total) + (len(w) - 1) * math.log(10))
    for run in ["therecats", "zzz", "athe", "x"]:
        splits = [[run[a:b] for a, b in zip((0, *cut), (*cut, len(run)))] for k in range(len(run)) for cut in itertools.combinations(range(1, len(run)), k)]
        assert sum(map(price, url_filter.best_split(run, costs, total))) == pytest.approx(min(sum(map(price, s)) for s in splits))


def test_containment_matches_brute_force(spark):
    import random

    rng = random.Random(8)
    word = lambda: f"W{rng.randrange(60)}"
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([1, 3, 5, 6, 9, 14, 20, 40, 80, 15])] + [(50, None), (51, " "), (52, "W1 w2 w3 W4 w5 w6"), (52, "W1 w2 w3 W4 w5 w6")]
    docs = []
    for i in range(80):
        parts = [" ".join(word() for _ in range(rng.randint(0, 200)))]
        if i % 2:
            words = rng.choice(items[:10])[1].split()
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(len(words))] = "changed"
            parts += [" ".join(words).lower(), word()]
        docs.append((i, " ".join(parts)))
    docs += [(200, None), (201, ""), (202, items[0][1]), (202, items[0][1]), (None, items[7][1])]

    def shingles(text):
        w = (text or "").lower().split()
        return {tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))} if w else set()

    want = {}
    for i, text in docs:
        have = shingles(text)
        want[i] = sorted({j for j, t in items if shingles(t) and i is not None and 100 * len(shingles(t) & have) >= 80 * len(shingles(t))})
    df = spark.createDataFrame([(t, i, i) for i, t in docs], "text string, doc_id bigint, h bigint")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {r["doc_id"]: r["item_ids"] for r in containment.contamination(df, bench).collect()}
    assert got == want and any(want.values())
    kept = containment.drop_contaminated(df, bench)
    assert kept.columns == df.columns and kept.count() == sum(1 for i, _ in docs if not want[i])
    assert containment.contamination(df.limit(0), bench).collect() == []
    assert not any(r["contaminated"] for r in containment.contamination(df, bench.limit(0)).collect())
