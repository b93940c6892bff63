"""Host rules and balanced shards on small tables."""

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import host_quality, sharding


def test_measures_of_odd_texts(spark):
    said = "a b c a b c d"
    rows = [(1, said, "h"), (2, None, "h"), (3, "", None), (4, "x\n\nx\n x \nx", "h"), (5, "#$ é ü <&>", "h"), (5, "#$ é ü <&>", "h"), (None, "w " * 60, "h"), (7, "q q q q", "h")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("host", F.lit(3))
    got = {(r["doc_id"]): r for r in host_quality.judge(df).collect()}
    assert (got[1]["n_words"], got[1]["n_repeat_words"], got[1]["word_chars"]) == (7, 6, 7)
    assert (got[2]["n_words"], got[2]["base_failed"], got[2]["kept"]) == (0, True, False)
    assert got[4]["n_dup_lines"] == 2 and got[4]["n_lines"] == 4
    assert (got[5]["n_symbols"], got[5]["word_chars"], got[5]["n_words"]) == (5, 8, 3)
    assert got[7]["n_repeat_words"] == 4
    assert len(host_quality.judge(df).collect()) == len(rows)
    assert host_quality.judge(df.limit(0)).collect() == []


def test_bad_hosts_take_their_documents_along(spark):
    good = " ".join(f"word{i}" for i in range(80))
    rows = [(i, good if i % 10 else "short", "good") for i in range(100)] + [(100 + i, good if i % 10 == 0 else "short", "bad") for i in range(60)] + [(900, "short", "tiny")]
    rows += [(1000 + 50 * h + i, good, f"host{h}") for h in range(10) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = {r["doc_id"]: r for r in host_quality.judge(df).collect()}
    assert not any(got[100 + i]["kept"] for i in range(60)) and got[1]["kept"] and not got[0]["kept"]
    rates = {r["host"]: r["rate_base"] for r in host_quality.host_rates(host_quality.measures(df, "doc_id", "text", "source")).collect()}
    assert 0.85 < rates["bad"] < 0.9 and rates["tiny"] < 1.0 and 0 < rates["host3"] < 0.05
    kept = host_quality.keep_good(df)
    assert kept.columns == df.columns and kept.count() == sum(r["kept"] for r in got.values())


def test_shards_are_even_and_keep_groups(spark):
    rows = [(i, f"text {i}" if i % 3 else f"group {i % 60}") for i in range(600)] + [(1000 + i, "hot") for i in range(300)] + [(5, "text 5"), (None, "n"), (None, None), (3000, "")]
    df = spark.createDataFrame([(t, i, 9) for i, t in rows], "text string, doc_id bigint, shard int")
    got = sharding.shard_documents(df, shards=6).toPandas()
    sizes = got.groupby("shard").size()
    assert len(got) == len(rows) and sizes.max() - sizes.min() <= 1 and set(got["shard"]) == set(range(6))
    for _, one in got.groupby("shard"):
        assert sorted(one["slot"]) == list(range(len(one)))
    spread = got[got["doc_id"].lt(600) & got["doc_id"].mod(3).eq(0)].assign(g=lambda d: d["doc_id"] % 60).groupby("g")["shard"].nunique()
    assert spread.mean() < 1.3  # by chance more than 4
    hot = got[got["doc_id"].between(1000, 1299)]["shard"].value_counts()
    assert hot.iloc[:2].sum() > 0.55 * hot.sum()  # evenly spread it would be a third
    assert sharding.shard_documents(df.limit(0), shards=6).collect() == []


def test_quotas_keep_all_counts():
    rng = np.random.default_rng(4)
    for _ in range(50):
        wishes, free = rng.integers(0, 30, (5, 5)) * rng.integers(0, 2, (5, 5)), rng.integers(0, 20, 5)
        np.fill_diagonal(wishes, 0)
        grant = sharding.granted(wishes, free)
        assert (grant <= wishes).all() and (grant >= 0).all()
        change = grant.sum(axis=0) - grant.sum(axis=1)
        pushed = np.zeros(5, int)
        for s, first, last, to in sharding.displaced(grant):
            assert 1 <= first <= last <= free[s]
            change[s] -= last - first + 1
            change[to] += last - first + 1
            pushed[s] += last - first + 1
        assert not change.any() and (pushed <= free).all()
