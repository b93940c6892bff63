"""Isotonic regression on any number of positions, by pooling neighbouring blocks in rounds."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import running
from millrace.session import cut, drop_cut

_BLOCKS = "part bigint, place bigint, size bigint, low double, weight double, total double"
ROUNDS = 1000


def pool(low: np.ndarray, weight: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge neighbouring blocks until their means rise."""
    kept: list[list[float]] = []
    for block in zip(low.tolist(), weight.tolist(), total.tolist()):
        kept.append(list(block))
        while len(kept) > 1 and kept[-2][2] * kept[-1][1] >= kept[-1][2] * kept[-2][1]:
            _, w, t = kept.pop()
            kept[-1][1] += w
            kept[-1][2] += t
    out = np.array(kept).reshape(-1, 3)
    return out[:, 0], out[:, 1], out[:, 2]


def _pooled(part: int, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("low")
    low, weight, total = pool(*(rows[c].to_numpy(float) for c in ("low", "weight", "total")))
    return pd.DataFrame({"part": part, "place": np.arange(len(low)), "size": len(low), "low": low, "weight": weight, "total": total})


def blocks_of(df: DataFrame, x: str, y: str) -> DataFrame:
    """(low, mean): where the steps of the best rising fit begin, and their heights.

    Equal positions are pooled first. Ranges of positions pool alone; then the upper half of
    each range is joined with the lower half of the next and pooled again, so the borders move
    each round, until no border is left where the means do not rise. A task holds about as many
    blocks as in the first round; the driver sees two means per range.
    """
    named = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(F.col(x).cast("double").alias("low")).agg(F.count("*").cast("double").alias("weight"), F.sum(F.col(y).cast("double")).alias("total"))
    ranged = named.repartitionByRange("low").withColumn("part", F.spark_partition_id().cast("bigint"))

    def join(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return _pooled(key[0], rows)

    state = cut(ranged.groupBy("part").applyInPandas(join, _BLOCKS))
    for turn in range(ROUNDS):
        # The means at both ends of each range; ranges are as many as partitions.
        mean = F.col("total") / F.col("weight")
        ends = state.groupBy("part").agg(F.min_by(mean, "place").alias("first"), F.max_by(mean, "place").alias("last")).orderBy("part").collect()
        if all(a["last"] < b["first"] for a, b in zip(ends, ends[1:])):
            out = cut(state.select("low", mean.alias("mean")))
            drop_cut(state)
            return out
        alone = (F.col("size") == 1) & (F.col("part") % 2 == turn % 2)  # single blocks move every other round, else two of them would never meet
        upper = ((F.col("place") * 2 >= F.col("size")) & (F.col("size") > 1) | alone).cast("bigint")
        moved = state.withColumn("part", F.floor((F.col("part") * 2 + upper + 1) / 2).cast("bigint"))
        last, state = state, cut(moved.groupBy("part").applyInPandas(join, _BLOCKS))
        drop_cut(last)
    raise RuntimeError("blocks did not settle")


def isotonic_fit(df: DataFrame, x: str, y: str, rising: bool = True) -> DataFrame:
    """(boundary, fitted) for every distinct position; rows with a null in either column do not count."""
    sign = 1.0 if rising else -1.0
    steps = blocks_of(df.withColumn("_y", F.col(y).cast("double") * sign), x, "_y")
    positions = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(F.col(x).cast("double").alias("boundary")).distinct()
    placed = positions.join(steps.withColumnRenamed("low", "boundary"), "boundary", "left")
    # Steps rise, so the highest step begun so far is the one a position lies on.
    return running(placed, [], ["boundary"], {"fitted": ("max", F.col("mean"), True)}).select("boundary", (F.col("fitted") * sign).alias("fitted"))
