"""Robust location and spread: the minimum covariance determinant, with all starts in one pass."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import tails
from millrace.operators.clustering import mahalanobis2
from millrace.operators.features import as_doubles
from millrace.operators.moments import partition_sum
from millrace.operators.ordered import quantiles
from millrace.operators.sampling import unit_number
from millrace.session import cut, drop_cut

ACCURACY = 100_000  # of the quantile that bounds the kept rows of a concentration step
BLOCK_VALUES = 1 << 17  # numbers measured together


def chi2_quantile(p: float, d: int) -> float:
    """Value below which a chi-square variable with d degrees lies with probability p."""
    low, high = 0.0, 10.0 * d + 100.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if tails.chi2_tail(mid, d) > 1 - p else (low, mid)
    return (low + high) / 2


def _spread(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cov = np.cov(x.T).reshape(x.shape[1], x.shape[1])
    return x.mean(axis=0), cov + np.eye(len(cov)) * max(np.trace(cov) / len(cov), 1e-12) * 1e-6


def _packed(rows: DataFrame) -> DataFrame:
    """(x): vectors one after another as 64-bit floats, about BLOCK_VALUES in a block; a null value is not a number."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["x"])

        for batch in batches:
            if batch.num_rows:
                values = batch.column(0).flatten().to_numpy(zero_copy_only=False)
                held.append(np.asarray(values, np.float64).tobytes())
                size += len(values)
            if size >= BLOCK_VALUES:
                yield block()
                held, size = [], 0
        if held:
            yield block()

    return cut(rows.select("v").mapInArrow(pack, "x binary"))


def _matrices(batch: pd.DataFrame, width: int) -> Iterator[np.ndarray]:
    """The vectors of each block as rows."""
    for raw in batch["x"]:
        yield np.frombuffer(raw, np.float64).reshape(-1, width)


def _ordered(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the floats, what is not a number behind all others."""
    bits = np.where(np.isnan(values), np.nan, values + 0.0).view(np.int64)  # no minus zero, one kind of not a number
    return np.where(bits < 0, ~bits, bits | np.int64(-(1 << 63))).view(np.uint64)


def _float(number: int) -> float:
    bits = number ^ (1 << 63) if number >> 63 else ~number & ((1 << 64) - 1)
    return float(np.array([bits], np.uint64).view(np.float64)[0])


def _ranked(blocks: DataFrame, distances: Callable[[np.ndarray], np.ndarray], width: int, count: int, rank: int, slack: float) -> np.ndarray:
    """Per start the distance of this rank, at most `slack` ranks above it.

    The floats are counted by their leading 16 bits, then by the next ones within the interval
    that holds the rank, until that has one value or few enough rows. What reaches the driver is one row
    per start and interval with rows.
    """
    leads, below, bounds = np.zeros(count, np.uint64), np.zeros(count, np.int64), np.full(count, np.nan)
    open_ = list(range(count))
    for bits in (16, 32, 48, 64):
        still, lead = list(open_), leads.copy()

        def counted(batches: Iterator[pd.DataFrame], bits: int = bits, still: list[int] = still, lead: np.ndarray = lead) -> Iterator[pd.DataFrame]:
            for x in (x for batch in batches for x in _matrices(batch, width)):
                every, parts = _ordered(distances(x)), []
                for s in still:
                    own = every[:, s]
                    if bits > 16:
                        own = own[own >> np.uint64(80 - bits) == lead[s]]
                    own = np.sort(own)
                    part = own >> np.uint64(64 - bits)
                    at = np.flatnonzero(np.r_[True, part[1:] != part[:-1]][: len(own)])
                    end = np.append(at[1:], len(own))[: len(at)]
                    parts.append(pd.DataFrame({"s": s, "part": (part[at] & np.uint64(0xFFFF)).astype(np.int64), "n": end - at, "low": _signed(own[at]), "high": _signed(own[end - 1])}))
                yield pd.concat(parts)

        found = blocks.mapInPandas(counted, "s int, part bigint, n bigint, low bigint, high bigint")
        sums = found.groupBy("s", "part").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
        held: dict[int, list] = {}
        for row in sums.collect():  # at most 65,536 per start
            held.setdefault(row["s"], []).append(row)
        open_ = []
        for s in still:
            for row in sorted(held[s], key=lambda r: r["part"]):
                if below[s] + row["n"] >= rank:
                    break
                below[s] += row["n"]
            bounds[s] = _float(row["high"] + (1 << 63))
            if row["low"] != row["high"] and row["n"] > 1 + slack:
                open_.append(s)
                leads[s] = leads[s] << np.uint64(16) | np.uint64(row["part"])
        if not open_:
            break
    return bounds


def _signed(numbers: np.ndarray) -> np.ndarray:
    """The same order in signed numbers, as tables know no others."""
    return (numbers ^ np.uint64(1 << 63)).view(np.int64)


def _concentrated(blocks: DataFrame, starts: list[tuple[np.ndarray, np.ndarray]], share: float, n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """One concentration step of every start: mean and covariance of the share of rows nearest under it."""
    means, inverses = np.stack([m for m, _ in starts]), np.stack([np.linalg.inv(c) for _, c in starts])
    width, count = means.shape[1], len(starts)

    def distances(x: np.ndarray) -> np.ndarray:
        return np.stack([np.einsum("ij,jk,ik->i", x - m, inv, x - m) for m, inv in zip(means, inverses)], axis=1)

    bounds = _ranked(blocks, distances, width, count, max(1, math.ceil(share * n)), n / ACCURACY)

    def sums(batch: pd.DataFrame) -> np.ndarray:
        total = np.zeros(count * (1 + width + width * width))
        for x in _matrices(batch, width):
            kept, parts = distances(x) <= bounds, []
            for s in range(count):
                own = x[kept[:, s]] - means[s]  # around the last mean, so nothing cancels
                parts += [[len(own)], own.sum(axis=0), (own.T @ own).ravel()]
            total += np.concatenate(parts)
        return total

    out = []
    for s, row in enumerate(partition_sum(blocks, sums, count * (1 + width + width * width)).reshape(count, -1)):
        size, gap = row[0], row[1 : 1 + width] / row[0]
        cov = row[1 + width :].reshape(width, width) / size - np.outer(gap, gap)
        out.append((means[s] + gap, cov + np.eye(width) * max(np.trace(cov) / width, 1e-12) * 1e-9))
    return out


def minimum_covariance(rows: DataFrame, key: str, starts: int = 30, finalists: int = 3, most: int = 30, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance of half the rows (key, v) with the smallest determinant, made consistent and reweighted.

    `starts` tries begin at d + 1 rows drawn by hash, one more at the medians; all make two
    concentration steps, `finalists` go on until their determinant stands.
    """
    width, n = len(rows.first()["v"]), rows.count()
    share = min(1.0, (n + width + 1) // 2 / n)
    drawn = np.array([r["v"] for r in rows.orderBy(unit_number(F.lit(f"mcd{seed}"), F.col(key)), key).limit(starts * (width + 1)).collect()])
    tries = [_spread(part) for part in np.array_split(drawn, max(1, min(starts, len(drawn) // (width + 1))))]
    middle = rows.agg(*[F.percentile_approx(F.col("v")[i], F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), ACCURACY).alias(f"q{i}") for i in range(width)]).first()
    quarter = np.array([middle[f"q{i}"] for i in range(width)])
    tries.append((quarter[:, 1], np.diag(np.maximum((quarter[:, 2] - quarter[:, 0]) / 1.349, 1e-9) ** 2)))
    size = lambda t: float(np.linalg.slogdet(t[1])[1])
    blocks = _packed(rows)
    for _ in range(2):
        tries = _concentrated(blocks, tries, share, n)
    tries = sorted(tries, key=size)[:finalists]
    for _ in range(most):
        last, tries = [size(t) for t in tries], _concentrated(blocks, tries, share, n)
        if all(abs(size(t) - b) < 1e-7 for t, b in zip(tries, last)):
            break
    drop_cut(blocks)
    mean, cov = min(tries, key=size)
    scored = cut(rows.select(key, "v", mahalanobis2(F.col("v"), mean, np.linalg.inv(cov)).alias("d")))
    scale = scored.agg(F.percentile_approx("d", 0.5, ACCURACY)).first()[0] / chi2_quantile(0.5, width)
    trusted = scored.where(F.col("d") <= scale * chi2_quantile(0.975, width)).select("v")

    def around(batch: pd.DataFrame) -> np.ndarray:
        x = np.stack(batch["v"].to_numpy()) - mean
        return np.concatenate([[len(x)], x.sum(axis=0), (x.T @ x).ravel()])

    row = partition_sum(trusted, around, 1 + width + width * width)
    drop_cut(scored)
    gap = row[1 : 1 + width] / row[0]
    return mean + gap, row[1 + width :].reshape(width, width) / row[0] - np.outer(gap, gap)


def robust_envelope(df: DataFrame, key: str, vector: str, contamination: float, **options) -> DataFrame:
    """(key, distance2, outlier): Mahalanobis distance to the robust centre and spread; the farthest share is flagged."""
    rows = cut(df.where(F.col(vector).isNotNull()).select(key, as_doubles(vector).alias("v")))
    mean, cov = minimum_covariance(rows, key, **options)
    scored = cut(rows.select(key, mahalanobis2(F.col("v"), mean, np.linalg.inv(cov)).alias("distance2")))
    drop_cut(rows)
    edge = quantiles(scored, [], "distance2", {"q": 1 - contamination}).first()["q"]
    return scored.select(key, "distance2", (F.col("distance2") > edge).alias("outlier"))
