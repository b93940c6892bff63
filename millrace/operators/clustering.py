"""Clusters and outliers."""

from __future__ import annotations

import math
from itertools import product

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.components import connected_components
from millrace.operators.features import as_doubles, matrix_map, random_fourier
from millrace.operators.moments import moments, partition_sum
from millrace.operators.neighbours import nearest_of
from millrace.operators.ordered import quantiles
from millrace.operators.sampling import hash_number
from millrace.session import cut


# --- k-means -----------------------------------------------------------------

def assign(df: DataFrame, vector: str, centres: list[tuple]) -> DataFrame:
    """Add `cluster` and squared distance `dist2`; centres are (id, vector)."""
    staged = df.withColumn("_best", nearest_of(as_doubles(vector), centres))
    return staged.withColumn("cluster", F.col("_best.id")).withColumn("dist2", F.col("_best.dist2")).drop("_best")


def centre_sums(assigned: DataFrame, vector: str) -> dict:
    """id -> (count, mean vector, sum of squared distances), combined before the shuffle."""
    rows = assigned.groupBy("cluster").agg(F.count("*").alias("n"), Summarizer.mean(array_to_vector(as_doubles(vector))).alias("m"), F.sum("dist2").alias("d"))
    return {r["cluster"]: (r["n"], r["m"].toArray(), r["d"]) for r in rows.collect()}  # one row per centre


def lloyd(df: DataFrame, vector: str, centres: list[tuple], steps: int) -> list[tuple]:
    """Plain Lloyd steps from given centres; an empty cluster keeps its centre."""
    for _ in range(steps):
        sums = centre_sums(assign(df, vector, centres), vector)
        centres = [(i, sums[i][1] if i in sums else v) for i, v in centres]
    return centres


def kmeans(df: DataFrame, k: int, start: str = "k-means||", seed: int = 0, iterations: int = 20):
    """Fitted model for `features`; start is "k-means||" (the parallel k-means++) or "random"."""
    return KMeans(k=k, initMode=start, seed=seed, maxIter=iterations).fit(df)


def pca_start(df: DataFrame, vector: str, k: int) -> list[tuple]:
    """The first k principal directions as starting centres."""
    values, vectors = np.linalg.eigh(moments(df, vector).covariance())
    order = np.argsort(values)[::-1][:k]
    return [(i, vectors[:, j]) for i, j in enumerate(order)]


def minibatch_update(centres: list[tuple], seen: dict, batch: DataFrame, vector: str):
    """One mini-batch step: each centre moves to the mean of all rows it has been given."""
    sums = centre_sums(assign(batch, vector, centres), vector)
    moved = []
    for i, v in centres:
        if i in sums:
            n, mean, _ = sums[i]
            seen[i] = seen.get(i, 0) + n
            v = np.asarray(v) + (mean - np.asarray(v)) * (n / seen[i])
        moved.append((i, v))
    return moved, seen


def match_centres(first: list[tuple], second: list[tuple]) -> dict:
    """For each centre of `first` the id of the closest of `second`."""
    b = np.array([v for _, v in second])
    return {i: second[int(((b - np.asarray(v)) ** 2).sum(axis=1).argmin())][0] for i, v in first}


# --- DBSCAN ------------------------------------------------------------------

KEYED_AXES = 4  # axes by which cells look for their neighbours; the others only filter


def _names(prefix: str, axes: list[str]) -> list[str]:
    return [f"{prefix}_{c}" for c in axes]


def _box_gaps(axes: list[str]) -> tuple[Column, Column]:
    """Smallest and largest squared distance between boxes a and b, structs of low and high values per axis."""
    near, far = F.lit(0.0), F.lit(0.0)
    for c in axes:
        gap = F.greatest(F.col(f"b.lo_{c}") - F.col(f"a.hi_{c}"), F.col(f"a.lo_{c}") - F.col(f"b.hi_{c}"), F.lit(0.0))
        reach = F.greatest(F.col(f"b.hi_{c}") - F.col(f"a.lo_{c}"), F.col(f"a.hi_{c}") - F.col(f"b.lo_{c}"))
        near, far = near + gap * gap, far + reach * reach
    return near, far


def _neighbour_cells(cells: DataFrame, axes: list[str], eps: float) -> DataFrame:
    """(a, b), a < b: cells whose bounding boxes are within eps of each other.

    A cell is narrower than eps, so lower corners of neighbours differ by less than 2 eps on
    every axis: they lie in the same or in touching cubes of that side. Only the widest axes
    make the cubes, so their number does not grow with the dimensions.
    """
    spread = cells.agg(*[(F.max(f"hi_{c}") - F.min(f"lo_{c}")).alias(c) for c in axes]).first()
    widest = sorted(axes, key=lambda c: -(spread[c] or 0.0))[:KEYED_AXES]
    box = F.struct("v", *_names("lo", axes), *_names("hi", axes))
    keyed = cells.select(box.alias("box"), *[F.floor(F.col(f"lo_{c}") / (2 * eps)).alias(f"k_{c}") for c in widest])
    shifts = F.array(*[F.struct(*[F.lit(s).alias(f"s_{c}") for s, c in zip(shift, widest)]) for shift in product((-1, 0, 1), repeat=len(widest)) if shift >= (0,) * len(widest)])
    left = keyed.withColumn("shift", F.explode(shifts)).select(F.col("box").alias("a"), *[(F.col(f"k_{c}") + F.col(f"shift.s_{c}")).alias(f"k_{c}") for c in widest],
                                                              F.expr(" and ".join(f"shift.s_{c} = 0" for c in widest)).alias("same"))
    both = left.join(keyed.withColumnRenamed("box", "b"), _names("k", widest)).where((F.col("a.v") < F.col("b.v")) | ~F.col("same"))
    near, _ = _box_gaps(axes)
    return both.where(near <= eps * eps).select(F.least("a.v", "b.v").alias("a"), F.greatest("a.v", "b.v").alias("b"))


def _cell_edges(core: DataFrame, pairs: DataFrame, axes: list[str], eps: float, side: float, levels: int = 30) -> DataFrame:
    """Those pairs of cells (a, b) that hold core points within eps of each other.

    Bounding boxes of ever finer sub-cells decide: boxes that are certainly close make an
    edge, boxes that are certainly apart are dropped, and only undecided ones are refined.
    A box around one point is always decided, so this is exact without comparing all pairs.
    """
    eps2, subs = eps * eps, _names("s", axes)
    shape = F.struct("v", *subs, *_names("lo", axes), *_names("hi", axes))

    def boxes(points: DataFrame, level: int) -> DataFrame:
        fine = side / (4**level)
        sub = [F.floor((F.col(c) - F.floor(F.col(c) / side) * side) / fine).alias(s) if level else F.lit(0).cast("bigint").alias(s) for c, s in zip(axes, subs)]
        return points.groupBy("v", *sub).agg(*[f(c).alias(f"{n}_{c}") for c in axes for n, f in (("lo", F.min), ("hi", F.max))])

    cells = boxes(core, 0).select(F.col("v"), shape.alias("n"))
    open_pairs = pairs.join(cells.select(F.col("v").alias("a"), F.col("n").alias("box_a")), "a").join(cells.select(F.col("v").alias("b"), F.col("n").alias("box_b")), "b").select(F.col("box_a").alias("a"), F.col("box_b").alias("b"))
    found, near_far = None, _box_gaps(axes)
    for level in range(levels):
        near, far = near_far
        judged = cut(open_pairs.where(near <= eps2).select("a", "b", (far <= eps2).alias("sure")))
        sure = judged.where("sure").select(F.col("a.v").alias("ca"), F.col("b.v").alias("cb")).distinct()
        found = sure if found is None else found.unionByName(sure)
        unsure = judged.where("not sure").withColumn("ca", F.col("a.v")).withColumn("cb", F.col("b.v"))
        unsure = cut(unsure.join(sure, ["ca", "cb"], "left_anti").select("a", "b"))
        if unsure.isEmpty():
            return found.select(F.col("ca").alias("a"), F.col("cb").alias("b"))
        wanted = unsure.select(F.col("a.v").alias("v")).unionByName(unsure.select(F.col("b.v").alias("v"))).distinct()
        halves = boxes(core.join(wanted, "v", "left_semi"), level + 1).select(shape.alias("n"), "v", *[F.floor(F.col(s) / 4).alias(s) for s in subs])
        halves = cut(halves)
        inside = lambda side_: [F.col("v") == F.col(f"{side_}.v"), *[F.col(s) == F.col(f"{side_}.{s}") for s in subs]]
        left = unsure.join(halves, inside("a")).select(F.col("n").alias("a"), "b")
        open_pairs = left.join(halves, inside("b")).select("a", F.col("n").alias("b"))
    raise RuntimeError("cell pairs stayed undecided")


def dbscan(points: DataFrame, eps: float, min_samples: int, axes: tuple[str, ...] = ("x", "y")) -> DataFrame:
    """Density clusters of (point_id, axes..): (point_id, cluster, is_core), in any number of dimensions.

    The cluster is the smallest core point id in it, -1 for noise; a border point joins the
    smallest cluster that reaches it. Equal points count as one weighted node; a cell has
    diagonal eps, so cells with enough rows are core without comparing their points, and core
    points of one cell always belong together. Only points of sparse cells are compared, with
    those of cells whose bounding boxes are within eps. Points with a null coordinate are noise.
    """
    axes = list(axes)
    side = eps / math.sqrt(len(axes)) * (1 - 1e-9)
    known = points.select("point_id", *[F.col(c).cast("double").alias(c) for c in axes]).dropna(subset=axes)
    nodes = known.groupBy(*axes).agg(F.min("point_id").alias("node"), F.count("*").alias("w"))
    nodes = cut(nodes.select("node", "w", *axes, *[F.floor(F.col(c) / side).alias(f"g_{c}") for c in axes]))
    grid = _names("g", axes)
    cells = cut(nodes.groupBy(*grid).agg(F.min("node").alias("v"), F.sum("w").alias("cell_w"), *[f(c).alias(f"{n}_{c}") for c in axes for n, f in (("lo", F.min), ("hi", F.max))]))
    nodes = cut(nodes.join(cells.select(*grid, "v", "cell_w"), grid).select("node", "w", "v", "cell_w", *axes))
    pairs = cut(_neighbour_cells(cells, axes, eps))
    around = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    gap2 = sum(((F.col(c) - F.col(f"at_{c}")) * (F.col(c) - F.col(f"at_{c}")) for c in axes), F.lit(0.0))
    asking = lambda rows: rows.select(F.col("node").alias("at"), F.col("v").alias("a"), *[F.col(c).alias(f"at_{c}") for c in axes])
    looking = asking(nodes.where(F.col("cell_w") < min_samples)).join(around, "a")
    reached = looking.join(nodes.select(F.col("v").alias("b"), "w", *axes), "b").where(gap2 <= eps * eps)
    outside = reached.groupBy("at").agg(F.sum("w").alias("near_w"))
    judged = nodes.join(outside, F.col("node") == F.col("at"), "left")
    flagged = cut(judged.select("node", "v", *axes, (F.col("cell_w") + F.coalesce("near_w", F.lit(0)) >= min_samples).alias("is_core")))
    core = flagged.where("is_core")
    named = cut(core.groupBy("v").agg(F.min("node").alias("least")))
    edges = _cell_edges(core, pairs, axes, eps, side)
    linked = edges.join(named.select(F.col("v").alias("a"), F.col("least").alias("la")), "a").join(named.select(F.col("v").alias("b"), F.col("least").alias("lb")), "b").select(F.col("la").alias("a"), F.col("lb").alias("b"))
    labels = named.join(connected_components(named.select(F.col("least").alias("v")), linked).select(F.col("v").alias("least"), "component"), "least").select("v", "component")
    core_labels = core.join(labels, "v")
    # a border point's own cell may hold core points too
    border = asking(flagged.where("not is_core"))
    border = border.join(around, "a").unionByName(border.withColumn("b", F.col("a")))
    border = border.join(core_labels.select(F.col("v").alias("b"), "component", *axes), "b").where(gap2 <= eps * eps)
    border = border.groupBy("at").agg(F.min("component").alias("component"))
    assigned = core_labels.select("node", "component").unionByName(border.select(F.col("at").alias("node"), "component"))
    placed = flagged.join(assigned, "node", "left").select(*[F.col(c).alias(f"at_{c}") for c in axes], "is_core", F.coalesce("component", F.lit(-1)).cast("bigint").alias("cluster"))
    same = [F.col(c).cast("double") == F.col(f"at_{c}") for c in axes]
    return points.join(placed, same, "left").select("point_id", F.coalesce("cluster", F.lit(-1).cast("bigint")).alias("cluster"), F.coalesce("is_core", F.lit(False)).alias("is_core"))


# --- outliers ----------------------------------------------------------------

def mahalanobis2(vector: Column, centre: np.ndarray, inverse: np.ndarray) -> Column:
    """Squared distance under an inverse covariance, in Arrow batches."""

    @F.pandas_udf("double")
    def measure(rows: pd.Series) -> pd.Series:
        if rows.empty:
            return pd.Series([], dtype="float64")
        gaps = np.stack(rows.to_numpy()).astype("float64") - centre
        return pd.Series(np.einsum("ij,jk,ik->i", gaps, inverse, gaps))

    return measure(vector)


def elliptic_envelope(df: DataFrame, key: str, vector: str, contamination: float, refits: int = 1, support: float = 0.75) -> DataFrame:
    """Mahalanobis distance to a trimmed centre and covariance; the farthest share is flagged.

    Each refit uses the `support` share of rows closest under the previous estimate.
    """
    rows = df.select(key, as_doubles(vector).alias("v"))
    estimate = moments(rows, "v")
    scored = None
    for step in range(refits + 1):
        inverse = np.linalg.inv(estimate.covariance())
        scored = rows.withColumn("distance2", mahalanobis2(F.col("v"), estimate.mean, inverse))
        if step < refits:
            edge = quantiles(scored, [], "distance2", {"q": support}).first()["q"]
            estimate = moments(scored.where(F.col("distance2") <= edge), "v")
    edge = quantiles(scored, [], "distance2", {"q": 1 - contamination}).first()["q"]
    return scored.select(key, "distance2", (F.col("distance2") > edge).alias("outlier"))


def _grow(rows: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    """Isolation tree as a flat list (feature, cut, left, right, size); feature -1 is a leaf."""
    nodes: list = []

    def add(part: np.ndarray, depth: int) -> int:
        at = len(nodes)
        nodes.append(None)
        low, high = part.min(axis=0), part.max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= limit or len(part) <= 1 or not len(usable):
            nodes[at] = (-1, 0.0, 0, 0, len(part))
            return at
        feature = int(rng.choice(usable))
        cut_at = float(rng.uniform(low[feature], high[feature]))
        goes = part[:, feature] < cut_at
        if not goes.any() or goes.all():
            nodes[at] = (-1, 0.0, 0, 0, len(part))
            return at
        left, right = add(part[goes], depth + 1), add(part[~goes], depth + 1)
        nodes[at] = (feature, cut_at, left, right, len(part))
        return at

    add(rows, 0)
    return nodes


def _average_path(n):
    n = np.asarray(n, dtype="float64")
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def isolation_forest(df: DataFrame, key: str, vector: str, trees: int = 50, sample: int = 256, contamination: float = 0.1, seed: int = 0) -> DataFrame:
    """Isolation score per row (higher is stranger) and the contamination share flagged.

    Rows are drawn for a tree by hash before anything is shuffled, so a tree's group has
    about `sample` rows however large the table is.
    """
    rows = df.select(key, as_doubles(vector).alias("v"))
    total = rows.count()
    share = min(1.0, 2.0 * sample / max(total, 1))
    lucky = lambda t: F.shiftrightunsigned(F.xxhash64(F.lit(seed), t, F.col(key)), 11) / float(1 << 53) < share
    chosen = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lucky)
    drawn = rows.withColumn("tree", F.explode(chosen)).withColumn("h", hash_number(F.lit(seed), F.col("tree"), F.col(key)))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        picked = group.sort_values(["h", key]).head(sample)
        data = np.stack(picked["v"].to_numpy())
        nodes = _grow(data, np.random.default_rng([seed, int(picked["tree"].iat[0])]), math.ceil(math.log2(max(len(data), 2))))
        return pd.DataFrame({"tree": [picked["tree"].iat[0]], "size": [len(data)], "nodes": [[list(map(float, n)) for n in nodes]]})

    grown = drawn.groupBy("tree").applyInPandas(build, "tree int, size int, nodes array<array<double>>").orderBy("tree").collect()
    forest = [np.array(r["nodes"]) for r in grown]  # trees x at most 2 * sample nodes
    norm = float(_average_path(np.mean([r["size"] for r in grown])))

    @F.pandas_udf("double")
    def score(batch: pd.Series) -> pd.Series:
        if batch.empty:
            return pd.Series([], dtype="float64")
        data = np.stack(batch.to_numpy())
        depth = np.zeros(len(data))
        for tree in forest:
            at, level = np.zeros(len(data), dtype=int), np.zeros(len(data))
            while True:
                inner = np.flatnonzero(tree[at, 0] >= 0)
                if not len(inner):
                    break
                node = tree[at[inner]]
                left = data[inner, node[:, 0].astype(int)] < node[:, 1]
                at[inner] = np.where(left, node[:, 2], node[:, 3]).astype(int)
                level[inner] += 1
            depth += level + _average_path(tree[at, 4])
        return pd.Series(2.0 ** (-depth / len(forest) / norm))

    scored = cut(rows.select(key, score("v").alias("score")))
    edge = quantiles(scored, [], "score", {"q": 1 - contamination}).first()["q"]
    return scored.withColumn("outlier", F.col("score") > edge)


def one_class_fit(df: DataFrame, vector: str, width: int, nu: float = 0.1, gamma: float = 0.1, components: int = 50,
                  steps: int = 15, rate: float = 0.5, seed: int = 0) -> dict:
    """One-class margin on random Fourier features.

    Each step is one aggregation: the mean of the mapped rows that fall below the margin.
    The final threshold leaves the share nu of the training rows below it.
    """
    mapped = cut(random_fourier(df.select(vector), vector, width, components, gamma, seed, "z").select("z"))
    n = mapped.count()
    w = mapped.select(Summarizer.mean(array_to_vector("z"))).first()[0].toArray()
    rho = 0.0
    for step in range(steps):
        def below(batch, w=w, rho=rho):
            z = np.stack(batch["z"].to_numpy())
            z = z[z @ w < rho]
            return np.append(z.sum(axis=0), len(z))

        row = partition_sum(mapped, below, len(w) + 1)
        scale = rate / (step + 1)
        w = w - scale * (w - row[:-1] / (nu * n))
        rho = rho - scale * (row[-1] / (nu * n) - 1)
    edge = quantiles(mapped.select(matrix_map("z", w[:, None])[0].alias("s")), [], "s", {"q": nu}).first()["q"]
    return {"weights": w, "edge": edge, "map": (width, components, gamma, seed)}


def one_class_score(df: DataFrame, vector: str, model: dict) -> DataFrame:
    """Add `score` (distance to the threshold) and `novel` (below it)."""
    width, components, gamma, seed = model["map"]
    mapped = random_fourier(df, vector, width, components, gamma, seed, "_z")
    scored = mapped.withColumn("score", matrix_map("_z", model["weights"][:, None])[0] - float(model["edge"])).drop("_z")
    return scored.withColumn("novel", F.col("score") < 0)

