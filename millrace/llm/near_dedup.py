"""Near-duplicate classes by banded MinHash with sequential Bayesian verification.

1. One pass over the texts gives the size, a 128-bit fingerprint and a MinHash signature of
   each shingle set. Documents with equal sets fall into one class by grouping fingerprints,
   so copies never meet in a bucket.
2. Bands of the class leaders' signatures are grouped into buckets. In a star round every
   member of a bucket that holds more than one component so far is paired with one leader
   of the bucket; pairs of a bucket are never emitted among all its members.
3. Pairs compare their signatures batch by batch. After each batch the posterior of the
   similarity (uniform prior, so Beta) says how likely it still reaches the threshold; a
   pair whose probability falls below `miss` is pruned. Survivors are verified on the full
   shingle sets.
4. Verified links are contracted to components. What a few star rounds leave apart within a
   bucket is compared in blocks of bounded size, across components only, so no link between
   members of a bucket is lost.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.texts import list_column, over_batches, raw_texts, shingle_set
from millrace.operators.components import connected_components
from millrace.session import cut

BLOCK = 256  # members outside a bucket's largest component that one task compares at a time
CHUNK = 1024  # members of the largest component that meet a block of the others
BLOCK_BYTES = 1 << 24  # texts of a block or a chunk, unless one is longer
STAR_ROUNDS = 3


def hash_family(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of n linear permutations of 32-bit values."""
    rng = np.random.default_rng(seed)
    return rng.integers(0, 2**32, n, dtype=np.uint32) | np.uint32(1), rng.integers(0, 2**32, n, dtype=np.uint32)


def signature(shingles: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Minimum of each permutation over the set, in slices of bounded size."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(len(family[0]), 2**32 - 1, np.uint32)
    for at in range(0, len(short), 4096):
        np.minimum(best, (short[at : at + 4096, None] * family[0] + family[1]).min(axis=0), out=best)
    return best


def least_matches(n: int, batch: int, percent: int, miss: float) -> list[int]:
    """Per batch end the fewest equal hashes with P(similarity >= percent / 100 | matches) >= miss.

    With a uniform prior, m matches of n give Beta(m + 1, n - m + 1); its upper tail at t is
    the chance of at most m successes in n + 1 draws of probability t.
    """
    t, out = percent / 100, []
    for seen in range(batch, n + 1, batch):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += math.comb(seen + 1, m) * t**m * (1 - t) ** (seen + 1 - m)
        out.append(m)
    return out


def alive_pairs(left: np.ndarray, right: np.ndarray, batch: int, least: list[int]) -> np.ndarray:
    """Positions of the signature pairs that no batch prunes."""
    alive, matches = np.arange(len(left)), np.zeros(len(left), np.int32)
    for i, fewest in enumerate(least):
        span = slice(i * batch, (i + 1) * batch)
        matches = matches + (left[alive, span] == right[alive, span]).sum(axis=1)
        keep = matches >= fewest
        alive, matches = alive[keep], matches[keep]
    return alive


def _signed(docs: DataFrame, id_col: str, text_col: str, size: int, n_hashes: int, seed: int) -> DataFrame:
    family = hash_family(n_hashes, seed)

    def sign(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(raw, size) for raw in raw_texts(batch.column(1))]
        mixed = [s * np.uint64(0x9E3779B97F4A7C15) for s in sets]
        return pa.RecordBatch.from_arrays([
            batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
            pa.array(np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)),
            pa.array(np.array([np.bitwise_xor.reduce(m ^ (m >> np.uint64(29))) if len(m) else 0 for m in mixed], np.uint64).view(np.int64)),
            list_column([signature(s, family).view(np.int32) if len(s) else np.empty(0, np.int32) for s in sets], pa.int32()),
        ], names=["doc_id", "n_shingles", "print_a", "print_b", "sig"])

    named = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return over_batches(named, sign, "doc_id bigint, n_shingles bigint, print_a bigint, print_b bigint, sig array<int>")


def _bands(signed: DataFrame, bands: int, rows: int) -> DataFrame:
    keys = F.array(*[F.xxhash64(F.lit(i), *[F.col("sig")[i * rows + j] for j in range(rows)]) for i in range(bands)])
    return signed.select("doc_id", F.posexplode(keys).alias("turn", "band"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _tested(pairs: DataFrame, pool: DataFrame, n_hashes: int, batch: int, least: list[int]) -> DataFrame:
    """Pairs (a, b) that the posterior bounds leave."""
    sigs = pool.select("doc_id", "sig")
    both = pairs.join(sigs.toDF("a", "sig_a"), "a").join(sigs.toDF("b", "sig_b"), "b").select("a", "b", "sig_a", "sig_b")

    def test(rows: pa.RecordBatch) -> pa.RecordBatch:
        alive = alive_pairs(_matrix(rows.column(2), n_hashes), _matrix(rows.column(3), n_hashes), batch, least)
        return rows.select(["a", "b"]).take(pa.array(alive))

    return over_batches(both, test, "a bigint, b bigint")


def _linked(pairs: DataFrame, pool: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs whose full shingle sets reach the threshold."""
    texts = pool.select("doc_id", "text")
    both = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b").select("a", "b", "text_a", "text_b")

    def verify(rows: pa.RecordBatch) -> pa.RecordBatch:
        known: dict[int, np.ndarray] = {}
        hits = []
        for i, (a, raw_a, raw_b) in enumerate(zip(rows.column(0).to_pylist(), raw_texts(rows.column(2)), raw_texts(rows.column(3)))):
            if a not in known:
                if len(known) >= 64:
                    known.clear()
                known[a] = shingle_set(raw_a, size)
            one, other = known[a], shingle_set(raw_b, size)
            common = len(np.intersect1d(one, other, assume_unique=True))
            if 100 * common >= percent * (len(one) + len(other) - common):
                hits.append(i)
        return rows.select(["a", "b"]).take(pa.array(hits, pa.int64()))

    return over_batches(both, verify, "a bigint, b bigint")


def _mixed_buckets(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(turn, band, doc_id, component, n) of buckets over several components; of equal buckets the first is left."""
    labelled = members.join(labels.select(F.col("v").alias("doc_id"), "component"), "doc_id")
    buckets = labelled.groupBy("band").agg(F.min("turn").alias("turn"), F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high"),
                                           F.sum(F.xxhash64("doc_id").cast("decimal(38,0)")).alias("print"))
    buckets = buckets.where("n > 2 and low < high").groupBy("n", "print").agg(F.min(F.struct("turn", "band"))["band"].alias("band"))
    return labelled.join(buckets, "band").select("turn", "band", "doc_id", "component", "n")


def common_counts(left: list[np.ndarray], right: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of all left with all right sets, by matrix products over slices of the shared items."""
    both = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)
    out = np.zeros((len(left), len(right)), np.float32)

    def table(sets: list[np.ndarray], items: np.ndarray) -> np.ndarray:
        rows = np.zeros((len(sets), len(items)), np.float32)
        for i, s in enumerate(sets):
            rows[i, np.searchsorted(items, np.intersect1d(s, items, assume_unique=True))] = 1
        return rows

    for at in range(0, len(both), width):
        items = both[at : at + width]
        out += table(left, items) @ table(right, items).T
    return out.astype(np.int64)


def spanning(pairs: list[tuple[int, int]], labels: list[int]) -> list[int]:
    """Positions of the pairs that join two sets still apart, members with one label being together."""
    parent: dict[int, int] = {}

    def find(v: int) -> int:
        while parent.setdefault(v, v) != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    out = []
    for at, (i, j) in enumerate(pairs):
        a, b = find(labels[i]), find(labels[j])
        if a != b:
            parent[a] = b
            out.append(at)
    return out


def _block_rows(mixed: DataFrame, pool: DataFrame) -> DataFrame:
    """(turn, band, kind, lo, hi, minor, of, doc_id, component): which members of a bucket meet in which task.

    Only members outside the bucket's largest component, the minor ones, have anything to be
    compared with: blocks of them meet each other (kind 0) and chunks of the largest component
    (kind 1). So a member of the largest component is sent once per block of minor ones. Blocks
    and chunks are bounded by members and by bytes.
    """
    sized = mixed.join(pool.select("doc_id", "bytes"), "doc_id")
    parts = sized.groupBy("band", "component").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    largest = parts.groupBy("band").agg(F.sum("n").alias("all_n"), F.sum("bytes").alias("all_bytes"), F.max(F.struct("n", "bytes", "component")).alias("top"))
    count = lambda n, most, size: F.greatest(F.ceil(n / most), F.ceil(size / BLOCK_BYTES), F.lit(1)).cast("int")
    plan = largest.select("band", F.col("top.component").alias("major"), count(F.col("all_n") - F.col("top.n"), BLOCK, F.col("all_bytes") - F.col("top.bytes")).alias("blocks"),
                          count(F.col("top.n"), CHUNK, F.col("top.bytes")).alias("chunks"))
    placed = mixed.join(plan, "band").withColumn("minor", F.col("component") != F.col("major"))
    placed = placed.withColumn("of", F.pmod(F.xxhash64("doc_id"), F.when(F.col("minor"), F.col("blocks")).otherwise(F.col("chunks"))).cast("int"))
    task = lambda kind, lo, hi: F.struct(F.lit(kind).alias("kind"), lo.alias("lo"), hi.alias("hi"))
    blocks, chunks = F.sequence(F.lit(0), F.col("blocks") - 1), F.sequence(F.lit(0), F.col("chunks") - 1)
    among = F.concat(F.transform(blocks, lambda y: task(0, F.least("of", y), F.greatest("of", y))), F.transform(chunks, lambda z: task(1, F.col("of"), z)))
    tasks = F.when(F.col("minor"), among).otherwise(F.transform(blocks, lambda x: task(1, x, F.col("of"))))
    return placed.select("turn", "band", "minor", "of", "doc_id", "component", F.explode(tasks).alias("t")).select("turn", "band", "t.kind", "t.lo", "t.hi", "minor", "of", "doc_id", "component")


def _in_blocks(mixed: DataFrame, pool: DataFrame, n_hashes: int, rows_per_band: int, batch: int, least: list[int], size: int, percent: int) -> DataFrame:
    """Verified links (a, b) between components within a bucket, found block against block.

    A pair is met in the first band that it shares. A task holds two blocks of signatures and
    sorted shingle hashes, and gives at most as many links as it has members: the links that
    join components still apart in it.
    """
    wanted = pool.join(mixed.select("doc_id").distinct(), "doc_id", "left_semi")

    def shingled(rows: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(raw, size).view(np.int64) for raw in raw_texts(rows.column(2))]
        return pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), list_column(sets, pa.int64())], names=["doc_id", "sig", "shingles"])

    ready = over_batches(wanted.select("doc_id", "sig", "text"), shingled, "doc_id bigint, sig array<int>, shingles array<bigint>")
    rows = _block_rows(mixed, pool).join(ready, "doc_id")

    def compare(group: pa.Table) -> pa.Table:
        turn, kind, lo, hi = (group[c][0].as_py() for c in ("turn", "kind", "lo", "hi"))
        of, minor = group["of"].to_numpy(), group["minor"].to_numpy(zero_copy_only=False)
        ids, comp = group["doc_id"].to_numpy(), group["component"].to_numpy()
        sig = _matrix(group["sig"].combine_chunks(), n_hashes)
        bands = sig[:, : turn * rows_per_band].reshape(len(sig), turn, rows_per_band)
        left, right, pairs = np.flatnonzero(minor & (of == lo)), np.flatnonzero(minor & (of == hi)) if kind == 0 else np.flatnonzero(~minor), []
        for i in left:
            j = right[(comp[right] != comp[i]) & ((ids[right] > ids[i]) | (kind == 1) | (lo != hi))]
            j = j[~(bands[j] == bands[i]).all(axis=2).any(axis=1)]
            j = j[alive_pairs(np.broadcast_to(sig[i], (len(j), n_hashes)), sig[j], batch, least)]
            pairs.append(np.column_stack([np.full(len(j), i), j]))
        pairs = np.concatenate(pairs) if pairs else np.empty((0, 2), np.int64)
        if len(pairs):
            shingles = group["shingles"].combine_chunks()
            one, other = np.unique(pairs[:, 0]), np.unique(pairs[:, 1])
            sets = {int(i): shingles[int(i)].values.to_numpy().view(np.uint64) for i in np.union1d(one, other)}
            common = common_counts([sets[i] for i in one.tolist()], [sets[i] for i in other.tolist()])
            common = common[np.searchsorted(one, pairs[:, 0]), np.searchsorted(other, pairs[:, 1])]
            sizes = np.array([len(sets[i]) if i in sets else 0 for i in range(len(ids))])
            pairs = pairs[100 * common >= percent * (sizes[pairs[:, 0]] + sizes[pairs[:, 1]] - common)]
            pairs = pairs[spanning(pairs.tolist(), comp.tolist())]
        return pa.table({"a": pa.array(ids[pairs[:, 0]], pa.int64()), "b": pa.array(ids[pairs[:, 1]], pa.int64())})

    return rows.groupBy("turn", "band", "kind", "lo", "hi").applyInArrow(compare, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, percent: int = 80,
                    bands: int = 32, band_rows: int = 4, batch: int = 32, miss: float = 1e-6, seed: int = 17) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per document.

    Documents are linked when 100 * intersection >= percent * union of their shingle sets;
    component_id is the smallest id that can be reached, kept is doc_id = component_id. Null
    and empty texts have no shingle and no link. A null id has a null component and is kept.
    A row repeated whole counts once; rows of one id are one document. Other columns are
    ignored. At the threshold itself a pair shares no band with probability
    (1 - 0.8 ** 4) ** 32 = 5e-8 and is pruned with about `miss` per batch.
    """
    n_hashes = bands * band_rows
    least = least_matches(n_hashes, batch, percent, miss)
    signed = cut(_signed(docs, id_col, text_col, shingle_words, n_hashes, seed))
    sets = ["n_shingles", "print_a", "print_b"]
    filled = signed.where("n_shingles > 0 and doc_id is not null")
    classes = cut(filled.groupBy(*sets).agg(F.min("doc_id").alias("leader"), F.count("*").alias("n")))
    # Rows of one id with several texts, if any, tie their classes together.
    led = filled.select("doc_id", *sets).join(classes.drop("n"), sets).select("doc_id", "n_shingles", "leader")
    leaders = filled.join(classes.select(F.col("leader").alias("doc_id"), *sets), ["doc_id", *sets]).select("doc_id", "sig").distinct()
    banded = _bands(leaders, bands, band_rows)
    shared = banded.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    members = cut(banded.join(shared, "band").select("turn", "band", "doc_id"))
    wanted = members.select("doc_id").distinct()
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).join(wanted, "doc_id", "left_semi")
    pool = cut(leaders.join(wanted, "doc_id").join(texts, "doc_id").select("doc_id", "sig", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("bytes")))
    vertices = filled.select(F.col("doc_id").alias("v")).distinct()
    links = led.where("doc_id <> leader").select(F.col("leader").alias("a"), F.col("doc_id").alias("b"))
    pool_ids = wanted.select(F.col("doc_id").alias("v"))
    stars = members.groupBy("band").agg(F.min("doc_id").alias("lead"))
    pairs = members.join(stars, "band").where("doc_id <> lead").select(F.col("lead").alias("a"), F.col("doc_id").alias("b")).distinct()
    found = cut(_linked(_tested(pairs, pool, n_hashes, batch, least), pool, shingle_words, percent))
    for turn in range(1, STAR_ROUNDS + 1):
        labels = connected_components(pool_ids, found)
        mixed = cut(_mixed_buckets(members, labels))
        if mixed.isEmpty():
            break
        if turn < STAR_ROUNDS:
            leads = mixed.groupBy("band").agg(F.min(F.struct(F.xxhash64("doc_id", F.lit(turn)).alias("h"), F.col("doc_id").alias("lead"), F.col("component").alias("of"))).alias("s"))
            pairs = mixed.join(leads, "band").where("component <> s.of").select(F.least("doc_id", "s.lead").alias("a"), F.greatest("doc_id", "s.lead").alias("b")).distinct()
            more = _linked(_tested(pairs, pool, n_hashes, batch, least), pool, shingle_words, percent)
        else:
            more = _in_blocks(mixed, pool, n_hashes, band_rows, batch, least, shingle_words, percent)
        found = cut(found.unionByName(more))
    labels = connected_components(vertices, links.unionByName(found))
    sized = signed.select("doc_id", "n_shingles").distinct()
    out = sized.join(labels.select(F.col("v").alias("doc_id"), "component"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def keep_one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The documents that near_duplicates keeps, with all their columns.

    Each id stays once: of rows with one id the one with the smallest text stays, a null text
    counting as empty, and rows equal in text too are one row. Rows without an id all stay.
    """
    text, others = options.get("text_col", "text"), [c for c in docs.columns if c != "doc_id"]
    verdicts = near_duplicates(docs, **options).where("kept").select(F.col("doc_id").alias("_kept_id")).distinct()
    named = docs.where("doc_id is not null").join(verdicts, F.col("doc_id") == F.col("_kept_id"), "left_semi")
    first = named.groupBy("doc_id").agg(F.min_by(F.struct(*[F.col(c) for c in others]), F.coalesce(text, F.lit(""))).alias("_row"))
    return first.select(*[F.col("doc_id") if c == "doc_id" else F.col("_row")[c].alias(c) for c in docs.columns]).unionByName(docs.where("doc_id is null"))
