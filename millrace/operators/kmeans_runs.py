"""K-means from many starts at once: oversampled seeding, random rows and principal directions.

Every pass over the rows serves all runs: distances to the centres of all runs are matrix
products in Arrow batches, and a partition sends one array of sums. What reaches the driver is
runs x k centres and, while seeding, the oversampled candidates of each run.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.decomposition import components_of
from millrace.operators.features import as_doubles
from millrace.operators.moments import moments, partition_sum
from millrace.operators.sampling import unit_number
from millrace.session import bounded_collect, cut, drop_cut

CANDIDATES = 200_000


@dataclass
class Run:
    start: str
    number: int
    centres: np.ndarray
    inertia: float = np.inf
    steps: int = 0


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] + (centres * centres).sum(axis=1) - 2 * x @ centres.T, 0.0)


def _matrix(batch: pd.DataFrame) -> np.ndarray:
    return np.stack(batch["v"].to_numpy()).astype("float64")


def weighted_seeds(points: np.ndarray, weights: np.ndarray, k: int, rng: np.random.Generator, steps: int = 20) -> np.ndarray:
    """k centres of weighted points in memory: drawn by squared distance, then moved by Lloyd steps."""
    chosen = [int(rng.choice(len(points), p=weights / weights.sum()))]
    while len(chosen) < min(k, len(points)):
        mass = _squares(points, points[chosen]).min(axis=1) * weights
        if mass.sum() <= 0:
            break
        chosen.append(int(rng.choice(len(points), p=mass / mass.sum())))
    centres = points[chosen].copy()
    for _ in range(steps):
        near = _squares(points, centres).argmin(axis=1)
        mass = np.bincount(near, weights, minlength=len(centres))
        sums = np.stack([np.bincount(near, weights * column, minlength=len(centres)) for column in points.T], axis=1)
        centres = np.where(mass[:, None] > 0, sums / np.maximum(mass, 1e-300)[:, None], centres)
    return np.vstack([centres, np.repeat(centres[:1], k - len(centres), axis=0)])  # fewer distinct points than k repeat a centre


def oversampled_seeds(rows: DataFrame, key: str, k: int, runs: int, rounds: int = 4, factor: float = 2.0, seed: int = 0) -> list[np.ndarray]:
    """Starting centres of several runs: each round draws about factor * k rows a run, by squared distance to those drawn before.

    Draws hash the row's key, so they do not depend on partitions. The rows nearest to each
    candidate weigh it, and the weighted candidates are clustered in memory.
    """
    first = [rows.orderBy(unit_number(F.lit(f"{seed}:{r}"), F.col(key)), key).limit(1).select("v") for r in range(runs)]
    firsts = first[0]
    for f in first[1:]:
        firsts = firsts.unionByName(f)
    found = [np.array(r["v"])[None, :] for r in firsts.collect()]
    for turn in range(rounds):
        current = [c.copy() for c in found]
        cost = partition_sum(rows, lambda b, c=current: np.array([_squares(_matrix(b), own).min(axis=1).sum() for own in c]), runs)
        wanted = np.where(cost > 0, factor * k / np.maximum(cost, 1e-300), 0.0)

        def draw(batches, c=current, wanted=wanted):
            for batch in batches:
                if len(batch):
                    x = _matrix(batch)
                    for r, own in enumerate(c):
                        hit = batch[f"u{r}"].to_numpy() < wanted[r] * _squares(x, own).min(axis=1)
                        if hit.any():
                            yield pd.DataFrame({"run": r, "v": list(x[hit])})

        chances = [unit_number(F.lit(f"{seed}:{turn}:{r}"), F.col(key)).alias(f"u{r}") for r in range(runs)]
        drawn = bounded_collect(rows.select("v", *chances).mapInPandas(draw, "run int, v array<double>"), CANDIDATES, "candidate centres")
        for r in range(runs):
            more = [row["v"] for row in drawn if row["run"] == r]
            found[r] = np.unique(np.vstack([found[r], *[np.array(v)[None, :] for v in more]]), axis=0)
    sizes = [len(c) for c in found]
    weights = partition_sum(rows, lambda b: np.concatenate([np.bincount(_squares(_matrix(b), own).argmin(axis=1), minlength=len(own)) for own in found]).astype(float), sum(sizes))
    parts = np.split(weights, np.cumsum(sizes)[:-1])
    return [weighted_seeds(c, w, k, np.random.default_rng((seed, r))) for r, (c, w) in enumerate(zip(found, parts))]


def fit_runs(df: DataFrame, key: str, vector: str, k: int, runs: int = 10, iterations: int = 30, tolerance: float = 1e-6, seed: int = 0) -> list[Run]:
    """All runs from k-means|| seeds (`runs`), random rows (`runs`), the k first rows by key, and principal directions, the best first.

    Runs stop moving by themselves when their inertia falls by less than `tolerance`. An empty
    cluster keeps its centre. Rows without a vector do not count.
    """
    rows = cut(df.where(F.col(vector).isNotNull()).select(key, as_doubles(vector).alias("v")))
    out = [Run("k-means||", r, c) for r, c in enumerate(oversampled_seeds(rows, key, k, runs, seed=seed))]
    width = out[0].centres.shape[1]
    drawn = bounded_collect(rows.orderBy(unit_number(F.lit(f"{seed}:random"), F.col(key)), key).limit(runs * k), CANDIDATES, "drawn rows")
    out += [Run("random", r, np.array([drawn[(r * k + i) % len(drawn)]["v"] for i in range(k)])) for r in range(runs)]
    out.append(Run("first rows", 0, np.array([r["v"] for r in rows.orderBy(key).limit(k).collect()])))
    whole = moments(rows, "v")
    axes, spread, _ = components_of(whole, min(k, width))
    out.append(Run("pca", 0, np.array([whole.mean + axes[:, i % axes.shape[1]] * np.sqrt(max(spread[i % axes.shape[1]], 0.0)) * (1 + i // axes.shape[1]) for i in range(k)])))
    out[-2].centres = np.vstack([out[-2].centres, np.repeat(out[-2].centres[:1], k - len(out[-2].centres), axis=0)])
    moving = list(out)
    for step in range(iterations + 1):
        current = [run.centres for run in moving]

        def sums(batch: pd.DataFrame, current=current) -> np.ndarray:
            x, parts = _matrix(batch), []
            for own in current:
                far = _squares(x, own)
                near = far.argmin(axis=1)
                hot = np.zeros((len(x), k))
                hot[np.arange(len(x)), near] = 1.0
                parts += [[far.min(axis=1).sum()], hot.sum(axis=0), (hot.T @ x).ravel()]
            return np.concatenate(parts)

        total = partition_sum(rows, sums, len(moving) * (1 + k + k * width)).reshape(len(moving), -1)
        still = []
        for run, row in zip(moving, total):
            settled, run.inertia = run.inertia - row[0] <= tolerance * row[0], float(row[0])
            if not settled and step < iterations:
                n, mass = row[1 : 1 + k], row[1 + k :].reshape(k, width)
                run.centres, run.steps = np.where(n[:, None] > 0, mass / np.maximum(n, 1)[:, None], run.centres), step + 1
                still.append(run)
        moving = still
        if not moving:
            break
    drop_cut(rows)
    return sorted(out, key=lambda r: (r.inertia, r.start, r.number))
