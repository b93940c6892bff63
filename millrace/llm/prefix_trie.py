"""Conversations in a z-fast trie: one compacted node per branch or end, found by fat binary search.

A prefix of d turns is known by a digest, the sum of its turns' hashes, each taken with its
place; so all prefixes of all conversations come from running sums, however long one is.
A compacted node stands for the edge of depths (a, b] that its members share. Its handle is
the prefix at the two-fattest depth of the edge, the number there divisible by the highest
power of two. A conversation of n turns finds the node where it leaves the trie in at most
log2(n) + 1 probes of the table of handles: a hit moves on to the end of that node's edge, a
miss moves back before the probed depth.

Conversations are inserted in batches. All that wait look for their exit at once; those that
end on an edge cut it there; of those that leave at one place with one next turn, one leads
and gets a new edge of its turns, the others look again in the next batch, from there on. The
leader is drawn by hash, so a group shrinks like the halves of a quicksort. Every depth of
every edge belongs to one leader, which later cuts do not change.

When nothing waits, members, smallest members, leaves and words are summed up the tree by
doubling: after k rounds each node knows its descendants up to 2 ** k nodes away. Edges are
expanded into one row per depth from the prefixes of their leader.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.texts import words
from millrace.operators.ordered import number_rows, running
from millrace.session import cut, drop_cut

LOW = 2**63 - 25  # a prime below 2 ** 63, so that sums of hashes become digests of one long
BATCHES = 200
CARRIED = 4096  # turns up to which a waiting conversation carries its digests, 16 bytes each
_EMPTY = hashlib.sha256(b"").hexdigest()


def fattest(low: Column, high: Column) -> Column:
    """The number in (low, high] divisible by the highest power of two; low < high."""
    shift = F.length(F.bin(low.bitwiseXOR(high))) - 1
    return high - high % F.pow(F.lit(2.0), shift).cast("bigint")


def rebuilt_turns(turns: DataFrame, group: int = 20, shared: int = 4) -> DataFrame:
    """(conv_id, depth, role, text): the first h turns of conversation c - c % group, then the own turns after the first h.

    h is crc32 of the decimal id modulo `shared`. Turns are ordered by turn (null first), ties
    by role and text; null roles and texts are empty.
    """
    own = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).where("conv_id is not null")
    placed = cut(number_rows(own, [F.col("turn").asc_nulls_first(), "role", "text"], "place", ["conv_id"]))
    takes = (F.crc32(F.col("conv_id").cast("string")) % shared).alias("takes")
    ids = placed.select("conv_id").distinct().select("conv_id", takes, (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    heads = placed.where(F.col("place") < shared).where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), "place", "role", "text")
    taken = heads.join(ids, "base").where("place <= takes").select("conv_id", F.col("place").alias("depth"), "role", "text")
    had = heads.groupBy("base").agg(F.max("place").alias("had"))
    moved = ids.join(had, "base", "left").select("conv_id", "takes", F.least("takes", F.coalesce("had", F.lit(0).cast("bigint"))).alias("before"))
    rest = placed.join(moved, "conv_id").where("place > takes").select("conv_id", (F.col("before") + F.col("place") - F.col("takes")).alias("depth"), "role", "text")
    return taken.unionByName(rest)


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, d1, d2, n_words, upto): digest of the first depth turns, words of the last and of all of them."""
    turn = F.md5(F.concat_ws("\n", F.col("depth").cast("string"), F.length("role").cast("string"), "role", "text"))
    halves = [F.conv(F.substring(turn, at, 16), 16, 10).cast("decimal(20,0)") for at in (1, 17)]
    hashed = turns.select("conv_id", "depth", halves[0].alias("h1"), halves[1].alias("h2"), F.size(words(F.col("text"))).cast("bigint").alias("n_words"))
    summed = running(hashed, ["conv_id"], ["depth"], {"s1": ("sum", F.col("h1"), True), "s2": ("sum", F.col("h2"), True), "upto": ("sum", F.col("n_words"), True)})
    return cut(summed.select("conv_id", "depth", *[(F.col(s) % F.lit(LOW).cast("decimal(20,0)")).cast("bigint").alias(d) for s, d in (("s1", "d1"), ("s2", "d2"))], "n_words", "upto"))


def _carrying(waiting: DataFrame, prefix: DataFrame) -> DataFrame:
    """The waiting conversations with the digests of all their prefixes as two arrays, for those of at most CARRIED turns."""
    rows = prefix.join(waiting.select(F.col("s").alias("conv_id")), "conv_id", "left_semi").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("depth", "d1", "d2"))).alias("z"))
    return waiting.join(rows.select(F.col("conv_id").alias("s"), F.col("z.d1").alias("o1"), F.col("z.d2").alias("o2")), "s")


def _own(state: DataFrame, depth: Column, prefix: DataFrame, names: list[str]) -> DataFrame:
    """Add each conversation's digest at `depth` under two names, null where there is none: from its arrays, or from the table of prefixes."""
    if "o1" in state.columns:
        at = (F.when(depth > 0, depth) - 1).cast("int")
        return state.withColumns({names[0]: F.get("o1", at), names[1]: F.get("o2", at)})
    table = prefix.select(F.col("conv_id").alias("s"), F.col("depth").alias("at"), F.col("d1").alias(names[0]), F.col("d2").alias(names[1]))
    return state.withColumn("at", depth).join(table, ["s", "at"], "left").drop("at")


def _table(marks: DataFrame, prefix: DataFrame) -> DataFrame:
    """One row per compacted node (rep, start, a, b) with the digests of its first depth, its handle and its end.

    marks are (rep, start, b): the nodes on the turns of each leader, which cut them into edges.
    """
    a = F.coalesce(F.lag("b").over(Window.partitionBy("rep").orderBy("b")), F.col("start"))
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), d.alias("depth")) for k, d in (("first", F.col("a") + 1), ("handle", fattest(F.col("a"), F.col("b"))), ("end", F.col("b")))]))
    rows = marks.select("rep", "start", a.alias("a"), "b").select("rep", "start", "a", "b", kinds.alias("k")).select("rep", "start", "a", "b", "k.kind", "k.depth")
    told = rows.join(prefix.select(F.col("conv_id").alias("rep"), "depth", "d1", "d2"), ["rep", "depth"])
    pick = lambda kind, column: F.max(F.when(F.col("kind") == kind, F.col(column))).alias(f"{kind}_{column}")
    columns = [pick(k, c) for k, c in (("first", "d1"), ("first", "d2"), ("handle", "depth"), ("handle", "d1"), ("handle", "d2"), ("end", "d1"), ("end", "d2"))]
    return cut(told.groupBy("rep", "start", "a", "b").agg(*columns))


def _probe(state: DataFrame, prefix: DataFrame, table: DataFrame, kind: str, depth: Column) -> DataFrame:
    """Look up each conversation's prefix at `depth` (below 1: nothing) and add the node found there (h_*), else nulls.

    Rows that look for nothing keep keys of their own, so that no key is shared by all of them.
    """
    asked = _own(state.withColumn("f", depth), F.col("f"), prefix, ["p1", "p2"])
    asked = asked.withColumn("p1", F.coalesce("p1", "s")).withColumn("p2", F.coalesce("p2", F.lit(-1).cast("bigint")))
    found = table.select((F.col("a") + 1 if kind == "first" else F.col("handle_depth")).alias("f"), F.col(f"{kind}_d1").alias("p1"), F.col(f"{kind}_d2").alias("p2"),
                         *[F.col(c).alias(f"h_{c}") for c in ("rep", "start", "a", "b")], F.col("end_d1").alias("h_e1"), F.col("end_d2").alias("h_e2"))
    return asked.join(found, ["f", "p1", "p2"], "left").drop("p1", "p2")


_NODE = ["rep", "start", "a", "b", "e1", "e2"]


def exits(waiting: DataFrame, table: DataFrame, prefix: DataFrame, probes: int) -> DataFrame:
    """(s, size, rep, start, a, b, lcp, n1, n2): the node where each waiting conversation leaves the trie, how many turns it shares, and its next digest.

    waiting has (s, size, rep, start, l), and the arrays of `_carrying` if its rows carry them:
    s shares l turns with the trie and they end at a node of rep. `probes` covers the widest
    search, the bits of l xor size. Where nothing follows, the exit is that node's end, with
    a = b. n1 and n2 are 0 where the conversation ends at its exit.
    """
    arrays = [c for c in ("o1", "o2") if c in waiting.columns]
    null = F.lit(None).cast("bigint")
    state = waiting.select("s", "size", *arrays, "rep", "start", F.col("l").alias("a"), F.col("l").alias("b"), null.alias("e1"), null.alias("e2"), F.col("size").alias("r"))
    hit = F.col("h_rep").isNotNull()
    for _ in range(probes):
        at = F.when(F.col("b") < F.col("r"), fattest(F.col("b"), F.col("r"))).otherwise(F.lit(-1).cast("bigint"))
        state = _probe(state, prefix, table, "handle", at).select("s", "size", *arrays, *[F.when(hit, F.col(f"h_{c}")).otherwise(F.col(c)).alias(c) for c in _NODE],
                                                                  F.when(hit | (F.col("f") < 0), F.col("r")).otherwise(F.col("f") - 1).alias("r"))
    # The last hit is the exit itself, or the exit hangs below its end. Without a hit, the known node is shared whole.
    state = _own(state, F.col("b"), prefix, ["q1", "q2"])
    whole = F.col("e1").isNull() | F.coalesce((F.col("q1") == F.col("e1")) & (F.col("q2") == F.col("e2")), F.lit(False))
    state = state.withColumn("whole", whole).drop("q1", "q2", "r")
    state = _probe(state, prefix, table, "first", F.when(F.col("whole") & (F.col("b") < F.col("size")), F.col("b") + 1).otherwise(F.lit(-1).cast("bigint")))
    from_a = F.when(hit, F.col("h_a")).when(F.col("whole"), F.col("b")).otherwise(F.col("a"))
    found = cut(state.select("s", "size", *arrays, *[F.when(hit, F.col(f"h_{c}")).otherwise(F.col(c)).alias(c) for c in ("rep", "start", "b")], from_a.alias("a")))
    # Equal prefixes along the exit's edge; they end where the conversation leaves it.
    reach = found.where("a < b").withColumn("to", F.least("b", "size"))
    if arrays:
        mine = reach.select("s", "rep", F.explode(F.arrays_zip(F.sequence(F.col("a") + 1, F.col("to")).alias("depth"), F.slice("o1", (F.col("a") + 1).cast("int"), (F.col("to") - F.col("a")).cast("int")).alias("d1"),
                                                               F.slice("o2", (F.col("a") + 1).cast("int"), (F.col("to") - F.col("a")).cast("int")).alias("d2"))).alias("z")).select("s", "rep", "z.depth", "z.d1", "z.d2")
    else:
        mine = reach.join(prefix.select(F.col("conv_id").alias("s"), "depth", "d1", "d2"), "s").where("depth > a and depth <= to").select("s", "rep", "depth", "d1", "d2")
    shared = mine.join(prefix.select(F.col("conv_id").alias("rep"), "depth", "d1", "d2"), ["rep", "depth", "d1", "d2"]).groupBy("s").agg(F.count("*").alias("n"))
    told = found.join(shared, "s", "left").withColumn("lcp", F.col("a") + F.coalesce("n", F.lit(0).cast("bigint")))
    told = _own(told, F.col("lcp") + 1, prefix, ["n1", "n2"]).fillna({"n1": 0, "n2": 0})
    left = cut(told.select("s", "size", *arrays, "rep", "start", "a", "b", "lcp", "n1", "n2"))
    drop_cut(found)
    return left


def build(sequences: DataFrame, prefix: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(edges, starts, placed) of the trie of the given distinct sequences (s, size), size > 0.

    edges: (rep, start, a, b); starts: (rep, parent), the leader on whose turns a leader's first
    edge hangs; placed: (s, rep, b), the node at which each sequence ends. The root is (0, 0).
    Sequences of at most CARRIED turns carry their digests, longer ones look them up by joins.
    """
    spark, zero = sequences.sparkSession, F.lit(0).cast("bigint")
    first = sequences.select("s", "size", zero.alias("rep"), zero.alias("start"), zero.alias("l"))
    short, long = cut(_carrying(first.where(F.col("size") <= CARRIED), prefix)), cut(first.where(F.col("size") > CARRIED))
    marks, starts, placed = (spark.createDataFrame([], t) for t in ("rep bigint, start bigint, b bigint", "rep bigint, parent bigint", "s bigint, rep bigint, b bigint"))
    for _ in range(BATCHES):
        sizes = short.select("l", "size", F.lit(True).alias("short")).unionByName(long.select("l", "size", F.lit(False).alias("short")))
        left_over = {r["short"]: r["probes"] for r in sizes.groupBy("short").agg(F.max(F.length(F.bin(F.col("l").bitwiseXOR(F.col("size"))))).alias("probes")).collect()}
        table = _table(marks, prefix)
        if not left_over:
            return table.select("rep", "start", "a", "b"), starts, placed
        found = [(waiting, exits(waiting, table, prefix, left_over[kind]) if kind in left_over else None) for kind, waiting in ((True, short), (False, long))]
        plain = ["s", "size", "rep", "start", "a", "b", "lcp", "n1", "n2"]
        every = [f.select(*plain) for _, f in found if f is not None]
        left = every[0] if len(every) == 1 else every[0].unionByName(every[1])
        leads = left.where("lcp < size").groupBy("rep", "lcp", "n1", "n2").agg(F.min(F.struct(F.xxhash64("s").alias("h"), "s", "size")).alias("lead"))
        leads = cut(leads.select("rep", "lcp", "lead.s", "lead.size"))
        # Inside an edge, what leaves or ends there cuts it.
        cuts = left.where("lcp > 0 and lcp < b").select("rep", "start", F.col("lcp").alias("b")).distinct()
        marks = marks.unionByName(cuts).unionByName(leads.select(F.col("s").alias("rep"), F.col("lcp").alias("start"), F.col("size").alias("b")))
        starts = starts.unionByName(leads.select(F.col("s").alias("rep"), F.col("rep").alias("parent")))
        placed = placed.unionByName(left.where("lcp = size").select("s", "rep", F.col("size").alias("b"))).unionByName(leads.select("s", F.col("s").alias("rep"), F.col("size").alias("b")))
        drop_cut(table)
        again = []
        for waiting, f in found:
            kept = [c for c in ("o1", "o2") if c in waiting.columns]
            again.append(cut(f.where("lcp < size").join(leads.select("s"), "s", "left_anti").select("s", "size", "rep", "start", F.col("lcp").alias("l"), *kept)) if f is not None else waiting)
            if f is not None:
                drop_cut(waiting)
        short, long = again
    raise RuntimeError("insertion did not settle")


def _ends_digest(ended: DataFrame) -> DataFrame:
    """(rep, b, ends_sha256) from (rep, b, conv_id): streamed in ascending order, so a task holds no list of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, out = None, None, []

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.string())],
                                              names=["rep", "b", "ends_sha256"])

        for batch in batches:
            reps, depths, ids = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            borders = np.flatnonzero((reps[1:] != reps[:-1]) | (depths[1:] != depths[:-1])) + 1
            for lo, hi in zip([0, *borders.tolist()], [*borders.tolist(), len(reps)]):
                if hi == lo:
                    continue
                text = ",".join(map(str, ids[lo:hi].tolist())).encode()
                if key == (int(reps[lo]), int(depths[lo])):
                    digest.update(b"," + text)
                else:
                    if key:
                        out.append((*key, digest.hexdigest()))
                    key, digest = (int(reps[lo]), int(depths[lo])), hashlib.sha256(text)
            if len(out) >= 2000:
                yield rows()
                out = []
        if key:
            out.append((*key, digest.hexdigest()))
        if out:
            yield rows()

    return ended.select("rep", "b", "conv_id").repartition("rep", "b").sortWithinPartitions("rep", "b", "conv_id").mapInArrow(run, "rep bigint, b bigint, ends_sha256 string")


def _subtree_sums(nodes: DataFrame) -> DataFrame:
    """Sums over each node's subtree of (n, ids, leaves, words_to, words_in), ids by minimum, by doubling the distance."""
    sums = {"n": F.sum, "low": F.min, "leaves": F.sum, "words_to": F.sum, "words_in": F.sum}
    state, first = nodes, True
    while not state.where("up is not null").isEmpty():
        more = state.where("up is not null").groupBy("up", "up_b").agg(*[f(c).alias(f"m_{c}") for c, f in sums.items()])
        more = more.select(F.col("up").alias("v"), F.col("up_b").alias("v_b"), *[f"m_{c}" for c in sums])
        lifted = state.select(F.col("v").alias("up"), F.col("up_b").alias("next_b"), F.col("v_b").alias("up_b"), F.col("up").alias("next"))
        # Nodes that have reached the root ask for themselves, not all for one missing key.
        asked = state.withColumn("k", F.coalesce("up", "v")).withColumn("k_b", F.coalesce("up_b", F.lit(-1).cast("bigint")))
        lifted = lifted.select(F.col("up").alias("k"), F.col("up_b").alias("k_b"), "next", "next_b")
        total = [F.least("low", "m_low").alias("low") if c == "low" else (F.col(c) + F.coalesce(f"m_{c}", F.lit(0).cast("bigint"))).alias(c) for c in sums]
        last, state = state, cut(asked.join(lifted, ["k", "k_b"], "left").join(more, ["v", "v_b"], "left").select("v", "v_b", F.col("next").alias("up"), F.col("next_b").alias("up_b"), *total))
        if not first:
            drop_cut(last)
        first = False
    return state


def prefix_trie(turns: DataFrame, group: int = 20, shared: int = 4) -> DataFrame:
    """One row per prefix of the rebuilt conversations (see `rebuilt_turns`).

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256,
    leader): conv_id is the smallest conversation that starts with the prefix, n_convs how many
    do, saved_tokens the sum over the subtree of (n_convs - 1) * words of the last text, and
    ends_sha256 the digest of the comma-joined ids of those that end there. The root has no
    parent. Null roles and texts are empty; rows without a conv_id belong to no conversation;
    equal rows are turns of their own; a conversation without turns is a member of the root;
    an empty table has no node. Other columns are ignored. Prefixes are compared by two digests
    of 63 bits. The ids that end at one prefix are hashed in order by one task, as a stream.
    """
    convs = turns.where("conv_id is not null").select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    given = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", "role", "text")
    prefix = prefixes(rebuilt_turns(given, group, shared))
    last = prefix.groupBy("conv_id").agg(F.max(F.struct("depth", "d1", "d2", "upto")).alias("z")).select("conv_id", F.col("z.depth").alias("size"), "z.d1", "z.d2", "z.upto")
    whole = cut(convs.join(last, "conv_id", "left").fillna(0))
    # Equal conversations are one sequence.
    alike = cut(whole.where("size > 0").groupBy("size", "d1", "d2").agg(F.min("conv_id").alias("s")))
    edges, starts, placed = build(alike.select("s", "size"), prefix)
    zero = F.lit(0).cast("bigint")
    named = whole.join(alike, ["size", "d1", "d2"], "left").join(placed, "s", "left")
    ended = cut(named.select("conv_id", F.coalesce("rep", zero).alias("rep"), F.coalesce("b", zero).alias("b"), "upto"))
    own = ended.groupBy("rep", "b").agg(F.count("*").alias("n"), F.min("conv_id").alias("low"), F.sum("upto").alias("words_to"))
    tops = edges.join(starts, "rep").select("rep", "a", "b", F.when(F.col("a") > F.col("start"), F.col("rep")).otherwise(F.col("parent")).alias("up"), F.col("a").alias("up_b"))
    # Words at both ends of every edge.
    words_at = prefix.select(F.col("conv_id").alias("rep"), F.col("depth"), "upto")
    tops = tops.join(words_at.toDF("rep", "b", "to_b"), ["rep", "b"]).join(words_at.toDF("rep", "a", "to_a"), ["rep", "a"], "left").fillna({"to_a": 0})
    roots = whole.select(zero.alias("rep"), zero.alias("a"), zero.alias("b"), F.lit(None).cast("bigint").alias("up"), F.lit(None).cast("bigint").alias("up_b"), zero.alias("to_b"), zero.alias("to_a")).limit(1)
    tops = cut(tops.withColumn("up", F.when(F.col("up_b") == 0, zero).otherwise(F.col("up"))).unionByName(roots))
    children = tops.where("up is not null").groupBy(F.col("up").alias("rep"), F.col("up_b").alias("b")).agg(F.count("*").alias("children"))
    nodes = cut(tops.join(own, ["rep", "b"], "left").join(children, ["rep", "b"], "left").fillna({"n": 0, "words_to": 0, "children": 0}))
    sums = _subtree_sums(nodes.select(F.col("rep").alias("v"), F.col("b").alias("v_b"), "up", "up_b", "n", "low", F.when(F.col("children") == 0, 1).otherwise(0).cast("bigint").alias("leaves"),
                                      "words_to", (F.col("to_b") - F.col("to_a")).alias("words_in")))
    sums = sums.select(F.col("v").alias("rep"), F.col("v_b").alias("b"), "n", "low", "leaves", "words_to", "words_in")
    facts = nodes.select("rep", "a", "b", "up", "up_b", "to_b", "to_a", "children").join(sums, ["rep", "b"])
    tops_of = sums.select(F.col("rep").alias("up"), F.col("b").alias("up_b"), F.col("low").alias("up_low"))
    facts = cut(facts.join(tops_of, ["up", "up_b"], "left").join(_ends_digest(ended), ["rep", "b"], "left"))
    steps = prefix.select(F.col("conv_id").alias("rep"), "depth", "n_words", "upto")
    spread = facts.where("b > 0").join(steps, "rep").where("depth > a and depth <= b")
    spread = spread.unionByName(facts.where("b = 0").select("*", zero.alias("depth"), zero.alias("n_words"), zero.alias("upto")))
    at_end, at_start = F.col("depth") == F.col("b"), F.col("depth") == F.col("a") + 1
    before = F.col("upto") - F.col("n_words")
    # Words of all member paths below `before`, less those of the distinct prefixes: words_in covers the edge from its start.
    saved = (F.col("words_to") - F.col("n") * before) - (F.col("words_in") - (before - F.col("to_a")))
    return spread.select(
        F.col("low").alias("conv_id"), "depth", F.when(F.col("depth") == 0, None).when(at_start, F.col("up_low")).otherwise(F.col("low")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.when(at_end, F.col("children")).otherwise(1).alias("n_children"), F.col("leaves").alias("n_leaves"), saved.alias("saved_tokens"),
        F.coalesce(F.when(at_end, F.col("ends_sha256")), F.lit(_EMPTY)).alias("ends_sha256"), F.col("rep").alias("leader"))
