"""Counts, means and centred cross products of vector rows: per partition, then merged.

Everything built on mean and covariance (components, discriminants, envelopes, factors)
starts from these, so the rows are read once and only d x d numbers reach the driver. Cross
products are taken around means, never as raw sums, so a large mean costs no digits.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.features import as_doubles
from millrace.session import bounded_collect, cut, drop_cut

# Most groups whose moments are brought to the driver.
MAX_GROUPS = 2_000


@dataclass
class Moments:
    n: float
    mean: np.ndarray
    centred: np.ndarray  # summed cross products around the mean

    @property
    def total(self) -> np.ndarray:
        return self.n * self.mean

    @property
    def cross(self) -> np.ndarray:
        return self.centred + self.n * np.outer(self.mean, self.mean)

    def scatter(self) -> np.ndarray:
        return self.centred

    def covariance(self, ddof: int = 1) -> np.ndarray:
        return self.centred / max(self.n - ddof, 1)

    def __add__(self, other: Moments) -> Moments:
        n, gap = self.n + other.n, other.mean - self.mean
        return Moments(n, self.mean + gap * (other.n / n), self.centred + other.centred + np.outer(gap, gap) * (self.n * other.n / n))


def moments_of(x: np.ndarray) -> Moments:
    """Moments of rows in memory."""
    mean = x[0] + (x - x[0]).mean(axis=0)
    centred = x - mean
    return Moments(float(len(x)), mean, centred.T @ centred)


def _reduced(rows: DataFrame, keys: list[str], columns: list[str]) -> list:
    """Add up per-partition arrays; one row per key value comes to the driver."""
    sums = rows.groupBy(*keys).agg(*[Summarizer.sum(array_to_vector(c)).alias(c) for c in columns])
    return bounded_collect(sums, MAX_GROUPS, "groups with sums")


def partition_sum(df: DataFrame, fn: Callable[[pd.DataFrame], np.ndarray], width: int) -> np.ndarray:
    """Sum of fn(batch) over all Arrow batches; every partition sends one array."""

    def per_partition(batches):
        total, any_rows = np.zeros(width), False
        for batch in batches:
            if len(batch):
                total, any_rows = total + fn(batch), True
        if any_rows:
            yield pd.DataFrame({"v": [total]})

    rows = _reduced(df.mapInPandas(per_partition, "v array<double>").withColumn("_g", F.lit(0)), ["_g"], ["v"])
    return rows[0]["v"].toArray() if rows else np.zeros(width)


def grouped_moments(df: DataFrame, vector: str, group: str | None = None) -> dict:
    """Moments per value of `group` (one entry under None without a group)."""
    rows = df.select(F.col(group).alias("_g") if group else F.lit(0).alias("_g"), as_doubles(vector).alias("_v"))

    def per_partition(batches):
        held: dict = {}
        for batch in batches:
            for g, part in batch.groupby("_g"):
                m = moments_of(np.stack(part["_v"].to_numpy()))
                held[g] = held[g] + m if g in held else m
        if held:
            yield pd.DataFrame({"_g": list(held), "n": [m.n for m in held.values()], "mean": [m.mean for m in held.values()], "centred": [m.centred.ravel() for m in held.values()]})

    kind = rows.schema["_g"].dataType.simpleString()
    parts = cut(rows.mapInPandas(per_partition, f"_g {kind}, n double, mean array<double>, centred array<double>"))
    # Partitions are added around one mean of their group, from which all of theirs are near.
    near = {r["_g"]: np.array(r["near"]) for r in bounded_collect(parts.groupBy("_g").agg(F.first("mean").alias("near")), MAX_GROUPS, "groups with sums")}

    def around(batches):
        for batch in batches:
            gaps = [np.asarray(m) - near[g] for g, m in zip(batch["_g"], batch["mean"])]
            yield pd.DataFrame({"_g": batch["_g"], "n": [[n] for n in batch["n"]], "s": [n * d for n, d in zip(batch["n"], gaps)],
                                "c": [np.asarray(c) + n * np.outer(d, d).ravel() for n, c, d in zip(batch["n"], batch["centred"], gaps)]})

    out = {}
    for r in _reduced(parts.mapInPandas(around, f"_g {kind}, n array<double>, s array<double>, c array<double>"), ["_g"], ["n", "s", "c"]):
        n, s, c = float(round(r["n"][0])), r["s"].toArray(), r["c"].toArray()
        out[r["_g"] if group else None] = Moments(n, near[r["_g"]] + s / n, c.reshape(len(s), len(s)) - np.outer(s, s) / n)
    drop_cut(parts)
    return out


def moments(df: DataFrame, vector: str) -> Moments:
    return grouped_moments(df, vector)[None]


def symmetric_power(matrix: np.ndarray, power: float, floor: float = 1e-12) -> np.ndarray:
    values, vectors = np.linalg.eigh(matrix)
    return vectors * np.maximum(values, floor) ** power @ vectors.T
