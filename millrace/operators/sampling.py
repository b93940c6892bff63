"""Splits, folds, draws and augmentation, repeatable on any cluster because they hash ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import number_rows
from millrace.session import cut


def hash_number(*parts: Column) -> Column:
    """A 60-bit number from the MD5 of the parts joined with ':'; the same in any engine."""
    text = F.concat_ws(":", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def unit_number(*parts: Column) -> Column:
    """Uniform in [0, 1)."""
    return hash_number(*parts) / F.lit(float(1 << 60))


def split_by_hash(df: DataFrame, key: str, train_share: float = 0.7, seed: int = 0) -> DataFrame:
    """Mark each row train or test by its key."""
    return df.withColumn("part", F.when(unit_number(F.lit(seed), F.col(key)) < train_share, "train").otherwise("test"))


def draw_with_replacement(df: DataFrame, key: str, size: int, seed: int = 0) -> DataFrame:
    """`size` (or as many as there are rows, if fewer) draws; column `draw` numbers them."""
    numbered = cut(number_rows(df, [key], "_row"))
    total = numbered.count()
    if total == 0:
        return numbered.drop("_row").withColumn("draw", F.lit(None).cast("bigint"))
    draws = df.sparkSession.range(min(size, total)).select(
        F.col("id").alias("draw"), (hash_number(F.lit(seed), F.col("id")) % total + 1).alias("_row"))
    return draws.join(numbered, "_row").drop("_row")


def folds(df: DataFrame, key: str, k: int, label: str | None = None, seed: int = 0) -> DataFrame:
    """Fold id 0..k-1 with sizes as even as possible, within each class if a label is given."""
    shuffled = df.withColumn("_h", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))))
    numbered = number_rows(shuffled, ["_h", key], "_n", [label] if label else None)
    return numbered.withColumn("fold", ((F.col("_n") - 1) % k).cast("int")).drop("_n", "_h")


def drop_extremes(df: DataFrame, key: str, column: str, n: int) -> DataFrame:
    """Without the n rows of highest `column`."""
    extreme = df.select(key, column).orderBy(F.desc(column), key).limit(n).select(key)
    return df.join(F.broadcast(extreme), key, "left_anti")


def random_cells(df: DataFrame, key: str, columns: int, rows: int, seed: int) -> DataFrame:
    """One uniformly drawn grid cell per row of `df`, as background."""
    return df.select(key, (hash_number(F.lit(f"x{seed}"), F.col(key)) % columns).alias("ix"), (hash_number(F.lit(f"y{seed}"), F.col(key)) % rows).alias("iy"))


# fixed values: row and column offset of each shifted copy
SHIFTS = {"same": (0, 0), "up": (-1, 0), "down": (1, 0), "left": (0, -1), "right": (0, 1)}


def shifted_copies(df: DataFrame, vector: str, side: int) -> DataFrame:
    """Each square image (row-major array) and its four one-pixel shifts, in one scan."""
    def moved(dr: int, dc: int) -> Column:
        inside = lambda i: ((F.floor(i / side) - dr).between(0, side - 1)) & ((i % side - dc).between(0, side - 1))
        source = lambda i: (i - dr * side - dc).cast("int")
        return F.transform(F.sequence(F.lit(0), F.lit(side * side - 1)),
                           lambda i: F.when(inside(i), F.get(F.col(vector), source(i))).otherwise(F.lit(0.0).cast("float")))

    copies = F.array(*[F.struct(F.lit(n).alias("shift"), moved(*d).alias("image")) for n, d in SHIFTS.items()])
    return df.withColumn("_c", F.explode(copies)).select(*[c for c in df.columns if c != vector], "_c.shift", F.col("_c.image").alias(vector))
