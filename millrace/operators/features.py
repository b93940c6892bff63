"""Feature transforms on columns and on array-valued vectors."""

from __future__ import annotations

from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import dense_index
from millrace.operators.sampling import unit_number
from millrace.session import bounded_collect

# Widest table one-hot encoding may produce; wider sets stay in label-encoded form.
MAX_DUMMIES = 5_000


def label_encode(df: DataFrame, column: str, name: str) -> DataFrame:
    """Sorted distinct values as 0..n-1; NULL stays NULL."""
    index = dense_index(df, column, name)
    return df.join(index.withColumn(name, F.col(name).cast("int")), column, "left")


def one_hot(df: DataFrame, column: str, values: list | None = None) -> DataFrame:
    """A 0/1 column per category, named column_value."""
    if values is None:
        distinct = df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)
        values = [r[0] for r in bounded_collect(distinct, MAX_DUMMIES, f"categories of {column}")]
    return df.select("*", *[F.coalesce((F.col(column) == v).cast("int"), F.lit(0)).alias(f"{column}_{v}") for v in values])


def impute_mean(df: DataFrame, columns: list[str], missing: float | None = None) -> DataFrame:
    """Replace NULL, and the sentinel if given, by the mean of the other values."""
    known = {c: F.when(F.col(c) != missing, F.col(c)) if missing is not None else F.col(c) for c in columns}
    means = df.agg(*[F.avg(v).alias(c) for c, v in known.items()]).first()
    return df.withColumns({c: F.coalesce(v, F.lit(means[c])) for c, v in known.items()})


def impute_most_frequent(df: DataFrame, column: str) -> DataFrame:
    """Fill NULL with the most frequent value; the smallest one on a tie."""
    top = df.where(F.col(column).isNotNull()).groupBy(column).count().orderBy(F.desc("count"), column).limit(1).collect()
    return df.na.fill({column: top[0][0]}) if top else df


def standardise(df: DataFrame, columns: list[str]) -> DataFrame:
    """Zero mean and unit population variance; a constant column becomes 0."""
    stats = df.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    return df.withColumns({c: (F.col(c) - stats[f"m_{c}"]) / (stats[f"s_{c}"] or 1.0) for c in columns})


def minmax_eps(df: DataFrame, columns: list[str], eps: float = 1e-4) -> DataFrame:
    stats = df.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))]).first()
    return df.withColumns({c: (F.col(c) - stats[f"lo_{c}"]) / (stats[f"hi_{c}"] + eps) for c in columns})


def as_doubles(vector: str | Column) -> Column:
    return (F.col(vector) if isinstance(vector, str) else vector).cast("array<double>")


def literal_vector(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def array_sum(vector: Column) -> Column:
    return F.aggregate(vector, F.lit(0.0), lambda s, v: s + v)


def dot(a: Column, b: Column) -> Column:
    return array_sum(F.zip_with(a, b, lambda x, y: x * y))


def column_means(df: DataFrame, vector: str) -> np.ndarray:
    """Mean vector, combined per partition in the JVM."""
    row = df.select(Summarizer.mean(array_to_vector(as_doubles(vector))).alias("m")).first()
    return row["m"].toArray()


def double_center(df: DataFrame, vector: str) -> DataFrame:
    """Subtract the column means, then each row's own mean."""
    centred = F.zip_with(as_doubles(vector), literal_vector(column_means(df, vector)), lambda x, m: x - m)
    staged = df.withColumn(vector, centred)
    return staged.withColumn(vector, F.transform(vector, lambda x: x - array_sum(F.col(vector)) / F.size(vector)))


def l2_normalise(df: DataFrame, vector: str) -> DataFrame:
    staged = df.withColumn(vector, as_doubles(vector)).withColumn("_norm", F.sqrt(dot(F.col(vector), F.col(vector))))
    scaled = F.transform(vector, lambda x: x / F.when(F.col("_norm") > 0, F.col("_norm")).otherwise(1.0))
    return staged.withColumn(vector, scaled).drop("_norm")


def polynomial(df: DataFrame, columns: list[str], degree: int, bias: bool = False) -> DataFrame:
    """All monomials up to the degree, lower degrees first; named like `a`, `a*b`."""
    out = [F.lit(1.0).alias("bias")] if bias else []
    for d in range(1, degree + 1):
        for names in combinations_with_replacement(columns, d):
            term = F.col(names[0]).cast("double")
            for n in names[1:]:
                term = term * F.col(n)
            out.append(term.alias("*".join(names)))
    rest = [c for c in df.columns if c not in columns]
    return df.select(*rest, *out)


def column_slice(df: DataFrame, vector: str, start: int, length: int) -> DataFrame:
    """Keep `length` components from 0-based `start`."""
    return df.withColumn(vector, F.slice(vector, start + 1, length))


def feature_union(df: DataFrame, branches: dict[str, tuple[list[Column], float]], name: str) -> DataFrame:
    """Branches of numeric columns, each scaled by its weight, joined into one vector."""
    parts = [(F.coalesce(c.cast("double"), F.lit(0.0)) * weight) for columns, weight in branches.values() for c in columns]
    return df.withColumn(name, F.array(*parts))


def dict_features(df: DataFrame, record: str, name: str) -> DataFrame:
    """A struct of named numbers as a vector in name order; missing entries are 0."""
    fields = sorted(f.name for f in df.schema[record].dataType.fields)
    return df.withColumn(name, F.array(*[F.coalesce(F.col(f"{record}.{f}").cast("double"), F.lit(0.0)) for f in fields]))


def noise_columns(df: DataFrame, key: str, count: int, seed: int = 0) -> DataFrame:
    """Standard normal columns derived from the row's key, so any cluster draws the same."""
    out = {}
    for i in range(count):
        u, v = unit_number(F.lit(seed), F.lit(2 * i), F.col(key)), unit_number(F.lit(seed), F.lit(2 * i + 1), F.col(key))
        out[f"noise_{i}"] = F.sqrt(F.log(1 - u) * -2.0) * F.cos(v * 2 * float(np.pi))
    return df.withColumns(out)


def matrix_map(vector: str | Column, weights: np.ndarray, finish=None) -> Column:
    """vector @ weights, then `finish`, in Arrow batches; the matrix travels with the closure."""

    @F.pandas_udf("array<double>")
    def apply(rows: pd.Series) -> pd.Series:
        if rows.empty:
            return rows
        out = np.stack(rows.to_numpy()).astype("float64") @ weights
        return pd.Series(list(finish(out) if finish else out))

    return apply(vector)


def random_fourier(df: DataFrame, vector: str, width: int, components: int, gamma: float, seed: int, name: str) -> DataFrame:
    """Features whose dot products approximate the RBF kernel exp(-gamma |x-y|^2)."""
    rng = np.random.default_rng(seed)
    weights = np.sqrt(2 * gamma) * rng.standard_normal((width, components))
    offset = rng.uniform(0, 2 * np.pi, components)
    scale = np.sqrt(2.0 / components)
    return df.withColumn(name, matrix_map(vector, weights, lambda m: scale * np.cos(m + offset)))


def rbf_kernel(a: np.ndarray, b: np.ndarray, gamma: float) -> np.ndarray:
    gaps = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T
    return np.exp(-gamma * np.maximum(gaps, 0))


def nystroem(df: DataFrame, key: str, vector: str, landmarks: int, gamma: float, name: str, seed: int = 0) -> DataFrame:
    """Kernel features against landmark rows picked by key hash."""
    rows = df.select(key, as_doubles(vector).alias("v")).orderBy(unit_number(F.lit(seed), F.col(key)), key).limit(landmarks).collect()
    base = np.array([r["v"] for r in rows])
    u, s, vt = np.linalg.svd(rbf_kernel(base, base, gamma))
    root = u / np.sqrt(np.maximum(s, 1e-12)) @ vt

    @F.pandas_udf("array<double>")
    def apply(batch: pd.Series) -> pd.Series:
        if batch.empty:
            return batch
        return pd.Series(list(rbf_kernel(np.stack(batch.to_numpy()).astype("float64"), base, gamma) @ root.T))

    return df.withColumn(name, apply(vector))


def chi2_kernel(vector: Column, landmarks: list[tuple], gamma: float) -> Column:
    """struct(id, k) per landmark with k = exp(-gamma * sum (x-y)^2/(x+y))."""
    def against(values):
        gaps = F.zip_with(vector, literal_vector(values), lambda x, y: F.coalesce(F.try_divide((x - y) * (x - y), x + y), F.lit(0.0)))
        return F.exp(array_sum(gaps) * -gamma)

    return F.array(*[F.struct(F.lit(i).alias("id"), against(v).alias("k")) for i, v in landmarks])


def long_form(df: DataFrame, key: str, vector: str, value: str = "value") -> DataFrame:
    return df.select(key, F.posexplode(vector).alias("pos", value))


def to_vector(df: DataFrame, vector: str, name: str = "features") -> DataFrame:
    """Array column to the vector type the learners take."""
    return df.withColumn(name, array_to_vector(as_doubles(vector)))


def to_array(column: str) -> Column:
    return vector_to_array(column)
