"""The stages in a row on the smallest data folder, each held against brute force on its own input."""

import duckdb
from conftest import SF_DIR

import corpus_pipeline
from millrace.llm.queries import CHECKS
from millrace.session import cut


def shingles(text):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[k : k + 5]) for k in range(max(len(w) - 4, 1))} if w else set()


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        texts.append({r["doc_id"]: r["text"] for r in docs.collect()})
        columns, docs = docs.columns, cut(stage(spark, docs, SF_DIR))
        assert docs.columns == columns, name
    texts.append({r["doc_id"]: r["text"] for r in docs.collect()})
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF_DIR}/documents.parquet'")
    judged = con.execute(CHECKS["op2_host_quality"]).df()
    assert set(texts[1]) == set(judged[judged["kept"]]["doc_id"])
    sets, comp = {i: shingles(t) for i, t in texts[1].items()}, {i: i for i in texts[1]}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) > 0]
    for _ in ids:
        for a, b in links:
            comp[a] = comp[b] = min(comp[a], comp[b])
    assert set(texts[2]) == {i for i in ids if comp[i] == i}
    first = {}
    for i in sorted(texts[2]):
        raw = texts[2][i].encode()
        for at in range(len(raw) - 49):
            first.setdefault(raw[at : at + 50], i)
    for i, text in texts[2].items():
        raw = text.encode()
        gone = bytearray(len(raw))
        for at in range(len(raw) - 49):
            if first[raw[at : at + 50]] < i:
                gone[at : at + 50] = b"\x01" * 50
        assert texts[3][i] == bytes(b for b, g in zip(raw, gone) if not g).decode(errors="ignore")
    items = [shingles(r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    assert set(texts[4]) == {i for i, t in texts[3].items() if not any(s and 100 * len(s & shingles(t)) >= 80 * len(s) for s in items)}
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).toPandas()
    assert set(last["doc_id"]) == set(texts[4]) and last["exact"].all() and not last.duplicated(["doc_id", "ids_crc32", "n_pieces"]).any()


def test_odd_rows_pass_every_stage(spark):
    """Null ids and texts, empty texts, repeated rows, columns that helpers use themselves, and an empty table."""
    words = " ".join(f"word{k} of the text" for k in range(40))
    rows = [(1, words, "en", "a", 9, 7), (1, words, "en", "a", 9, 7), (2, words, "en", None, 9, 7), (None, words, None, "a", 0, 7), (None, None, "en", "a", 0, 7), (3, "", "en", "a", 0, 7), (4, None, "en", "b", 0, 7),
            (5, words.upper() + " x", "en", "b", 1, 7)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, component bigint")
    for given in (docs, docs.limit(0)):
        ids = []
        for name, stage in corpus_pipeline.STAGES[:-1]:
            columns, given = given.columns, cut(stage(spark, given, SF_DIR))
            assert given.columns == columns, name
            ids.append(sorted((r["doc_id"] or 0) for r in given.collect()))
        last = corpus_pipeline.STAGES[-1][1](spark, given, SF_DIR).collect()
        assert {r["doc_id"] for r in last} <= {r["doc_id"] for r in given.collect()}
        assert set(ids[1]) <= set(ids[0]) and ids[2] == ids[1] and set(ids[3]) <= set(ids[2])
