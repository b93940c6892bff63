"""Nearest rows by Euclidean distance: against a small codebook, and exact k nearest
neighbours between two tables of any size."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.ordered import number_rows
from millrace.session import cut

# A codebook up to this many numbers is sent to every task as a whole.
CODEBOOK_NUMBERS = 1_000_000
# Rows of either side that one task compares at a time, and most blocks of rows whose shapes go to every task.
BLOCK = 2_000
MAX_BLOCKS = 500_000
# Most numbers of a distance table, or of the vectors in a batch, that a Python task holds at once.
BATCH_NUMBERS = 1_000_000


def distances_to(vector: Column, codebook: np.ndarray) -> Column:
    """Distances to every codebook row, in Arrow batches; the codebook travels with the closure."""
    per_slice = max(1, 2_000_000 // max(codebook.size, 1))

    @F.pandas_udf("array<double>")
    def measure(rows: pd.Series) -> pd.Series:
        if rows.empty:
            return rows
        data, out = np.stack(rows.to_numpy()).astype("float64"), []
        for at in range(0, len(data), per_slice):
            gaps = data[at:at + per_slice, None, :] - codebook[None, :, :]
            out.extend(np.sqrt((gaps * gaps).sum(axis=2)))
        return pd.Series(out)

    return measure(vector)


def _squared_gaps(data: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all codebook rows; short vectors are summed up column by column."""
    if book.shape[1] >= 8:
        gaps = data[:, None, :] - book[None, :, :]
        return (gaps * gaps).sum(axis=2)
    out = np.zeros((len(data), len(book)))
    for j in range(book.shape[1]):
        gap = data[:, j, None] - book[None, :, j]
        gap *= gap
        out += gap
    return out


def nearest_of(vector: Column, codebook: list[tuple]) -> Column:
    """struct(dist2, id) of the closest of (id, vector) entries; ties go to the lower id."""
    ordered = sorted(codebook, key=lambda e: e[0])
    ids, book = np.array([i for i, _ in ordered], dtype="int64"), np.array([[float(x) for x in v] for _, v in ordered])
    # Rows of one slice: its distances stay in the processor's cache where vectors are short.
    per_slice = max(1, (100_000 if book.shape[1] < 8 else 2_000_000) // max(book.size, 1))

    @F.arrow_udf("dist2 double, id bigint")
    def closest(rows: pa.Array) -> pa.Array:
        if not len(rows):
            return pa.StructArray.from_arrays([pa.array([], pa.float64()), pa.array([], pa.int64())], ["dist2", "id"])
        if rows.null_count or len(set(np.diff(rows.offsets.to_numpy()))) > 1:
            raise ValueError("vectors must not be null and must have one length")
        data, dist, best = rows.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(len(rows), -1), [], []
        for at in range(0, len(data), per_slice):
            d = _squared_gaps(data[at:at + per_slice], book)
            pick = d.argmin(axis=1)
            best.append(ids[pick])
            dist.append(d[np.arange(len(pick)), pick])
        return pa.StructArray.from_arrays([pa.array(np.concatenate(dist), from_pandas=True), pa.array(np.concatenate(best))], ["dist2", "id"])

    return closest(vector)


def assign_nearest(points: DataFrame, point_id: str, vector: str, centres: DataFrame, centre_id: str, centre_vector: str) -> DataFrame:
    """(point_id, centre_id, distance), ties to the lower centre id; ids of any type keep it.

    Centres are numbered in id order and found by number. A codebook of a checked size goes to
    every task, a larger one through the tile search, with the same result.
    """
    numbered = cut(number_rows(centres.select(F.col(centre_id).alias("_id"), F.col(centre_vector).cast("array<double>").alias("_vector")), ["_id"], "_at"))
    size = numbered.select(F.max(F.size("_vector")), F.count("*")).first()
    if (size[0] or 0) * size[1] <= CODEBOOK_NUMBERS:
        book = [(r["_at"], r["_vector"]) for r in numbered.collect()]
        found = points.withColumn("_best", nearest_of(F.col(vector).cast("array<double>"), book)).select(
            point_id, F.col("_best.id").alias("_at"), F.sqrt("_best.dist2").alias("distance"))
    else:
        found = nearest_rows(points.select(F.col(point_id).alias("query_id"), F.col(vector).alias("vector")),
                             numbered.select(F.col("_at").alias("row_id"), F.col("_vector").alias("vector")), 1).select(F.col("query_id").alias(point_id), F.col("row_id").alias("_at"), "distance")
    return found.join(numbered.select("_at", F.col("_id").alias(centre_id)), "_at").select(point_id, centre_id, "distance")


def _compare(k: int, slice_rows: int = 512):
    def compare(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or rows.empty:
            return pd.DataFrame({"query_id": queries["query_id"][:0], "row_id": np.empty(0, "int64"), "distance": np.empty(0)})
        by_id = np.argsort(rows["row_id"].to_numpy(), kind="stable")
        ids = rows["row_id"].to_numpy()[by_id]
        base, asked = (np.stack(t["vector"].to_numpy()).astype("float64") for t in (rows, queries))
        base = base[by_id]
        kept, square = min(k, len(ids)), (base * base).sum(axis=1)
        out = []
        for at in range(0, len(asked), slice_rows):
            part = asked[at : at + slice_rows]
            # The matrix product finds candidates; what may be among the k nearest is measured exactly.
            rough = square - 2 * part @ base.T
            limit = np.partition(rough, kept - 1, axis=1)[:, kept - 1]
            slack = 1e-9 * (np.abs(limit) + (part * part).sum(axis=1) + square.max() + 1e-300)
            which, near = np.nonzero(rough <= (limit + slack)[:, None])
            exact = np.sqrt(((base[near] - part[which]) ** 2).sum(axis=1))
            order = np.lexsort((near, exact, which))
            which, near, exact = which[order], near[order], exact[order]
            first = np.searchsorted(which, np.arange(len(part)))
            keep = np.arange(len(which)) - first[which] < kept
            out.append(pd.DataFrame({"query_id": queries["query_id"].to_numpy()[at + which[keep]], "row_id": ids[near[keep]], "distance": exact[keep]}))
        return pd.concat(out)

    return compare


def _pivots(rows: DataFrame, count: int) -> np.ndarray:
    """`count` rows drawn by the hash of their ids, without repeats of a vector."""
    drawn = rows.select("vector", F.xxhash64("row_id", F.lit(7)).alias("h"), "row_id").orderBy("h", "row_id").limit(count)
    return np.unique(np.array([r["vector"] for r in drawn.collect()], "float64"), axis=0)


def _to_pivots(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (vectors * vectors).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1) - 2 * vectors @ pivots.T
    return np.sqrt(np.maximum(square, 0.0))


def metric_blocks(rows: DataFrame, pivots: np.ndarray, size: int) -> tuple[DataFrame, pd.DataFrame]:
    """(row_id, vector, block) and one row per block: its pivot, nearest and farthest distance, and rows.

    A row belongs to the cell of its nearest pivot; a cell is cut by distance into rings of at
    most `size` rows, also where a cell holds most rows.
    """
    @F.pandas_udf("cell int, far double")
    def nearest(vectors: pd.Series) -> pd.DataFrame:
        if vectors.empty:
            return pd.DataFrame({"cell": pd.Series(dtype="int32"), "far": pd.Series(dtype="float64")})
        far = _to_pivots(np.stack(vectors.to_numpy()).astype("float64"), pivots)
        return pd.DataFrame({"cell": far.argmin(axis=1).astype("int32"), "far": far.min(axis=1)})

    placed = rows.select("row_id", "vector", nearest("vector").alias("n")).select("row_id", "vector", F.col("n.cell").alias("cell"), F.col("n.far").alias("far"))
    numbered = number_rows(placed, ["far", "row_id"], "at", ["cell"])
    ringed = cut(numbered.select("row_id", "vector", "far", "cell", F.floor((F.col("at") - 1) / size).cast("int").alias("ring")))
    shapes = ringed.groupBy("cell", "ring").agg(F.min("far").alias("low"), F.max("far").alias("high"), F.count("*").alias("n")).toPandas()  # at most MAX_BLOCKS and the pivots
    shapes = shapes.sort_values(["cell", "ring"]).reset_index(drop=True)
    names = rows.sparkSession.createDataFrame(shapes.reset_index()[["cell", "ring", "index"]])
    return ringed.join(F.broadcast(names), ["cell", "ring"]).select("row_id", "vector", F.col("index").cast("int").alias("block")), shapes


def _own_block(far: np.ndarray, shapes: pd.DataFrame, k: int) -> np.ndarray:
    """The block with k rows or more that a query most likely shares with its nearest rows; -1 if no block has k."""
    cell, low, high = (shapes[c].to_numpy() for c in ("cell", "low", "high"))
    full = np.flatnonzero(shapes["n"].to_numpy() >= k)
    if not len(full):
        return np.full(len(far), -1)
    gap = np.maximum(np.maximum(low[full] - far[:, cell[full]], far[:, cell[full]] - high[full]), 0.0) + 1e-3 * far[:, cell[full]]
    return full[gap.argmin(axis=1)]


def _allowed(far: np.ndarray, bound: np.ndarray, pivots: np.ndarray, shapes: pd.DataFrame) -> np.ndarray:
    """Which blocks can hold a row within each query's bound: by the ring, and by the plane between the query's pivot and the cell's."""
    cell, low, high = (shapes[c].to_numpy() for c in ("cell", "low", "high"))
    to = far[:, cell]
    gap = np.maximum(low - to, to - high)
    own = far.argmin(axis=1)
    between = _to_pivots(pivots[own], pivots)[:, cell]
    plane = np.where(between > 0, (to**2 - far.min(axis=1)[:, None] ** 2) / np.maximum(2 * between, 1e-300), -np.inf)
    slack = 1e-9 * (1.0 + to + far.max(axis=1)[:, None])
    return np.maximum(gap, plane) <= bound[:, None] + slack


def _spread(chosen, columns: list[str], pivots: np.ndarray, blocks: int):
    """Batches of queries with the blocks chosen for them. A query may visit every block, so batches are
    bounded by the numbers they hold, not by queries."""
    rows_out = max(1, BATCH_NUMBERS // max(pivots.shape[1], 1))

    def run(batches):
        for batch in batches:
            step = max(1, BATCH_NUMBERS // max(blocks, len(pivots)))
            for at in range(0, len(batch), step):
                part = batch.iloc[at : at + step]
                far = _to_pivots(np.stack(part["vector"].to_numpy()).astype("float64"), pivots)
                which, block = chosen(part, far)
                for cut_at in range(0, len(which), rows_out):
                    own = slice(cut_at, cut_at + rows_out)
                    yield part.iloc[which[own]][columns].assign(block=block[own].astype("int32"))

    return run


def visits(queries: DataFrame, rows: DataFrame, k: int, size: int = BLOCK) -> tuple[DataFrame, DataFrame, int]:
    """((query_id, vector, block) to be visited, (row_id, vector, block), number of blocks), vectors being arrays of doubles.

    A first pass compares each query with one block near it; the k-th distance found there
    bounds the second pass, which visits every block that the triangle inequality allows. Where
    no block holds k rows, all blocks are visited.
    """
    total, width = rows.count(), len((rows.first() or {"vector": [0.0]})["vector"])
    size = max(size, math.ceil(total / MAX_BLOCKS))
    pivots = _pivots(rows, max(1, min(math.ceil(total / size), CODEBOOK_NUMBERS // max(width, 1))))
    blocks, shapes = metric_blocks(rows, pivots, size)
    kind = queries.schema["query_id"].dataType.simpleString()

    def spread(chosen, columns: list[str]):
        return _spread(chosen, columns, pivots, len(shapes))

    def first(part, far):
        block = _own_block(far, shapes, k)
        which = np.flatnonzero(block >= 0)
        return which, block[which]

    near = _tiles(queries.mapInPandas(spread(first, ["query_id", "vector"]), f"query_id {kind}, vector array<double>, block int"), blocks, k, kind)
    bounds = near.groupBy("query_id").agg(F.max("distance").alias("bound"))
    asked = cut(queries.join(bounds, "query_id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf")))))

    def second(part, far):
        return np.nonzero(_allowed(far, part["bound"].to_numpy(), pivots, shapes))

    found = asked.mapInPandas(spread(second, ["query_id", "vector"]), f"query_id {kind}, vector array<double>, block int")
    return cut(found), blocks, len(shapes)


def _tiles(asked: DataFrame, blocks: DataFrame, k: int, kind: str) -> DataFrame:
    """(query_id, row_id, distance): the k best of each visited block; a block with many visitors is compared in several tasks."""
    crowds = asked.groupBy("block").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    left = asked.join(F.broadcast(crowds), "block").withColumn("turn", F.pmod(F.xxhash64("query_id"), F.col("parts")).cast("int"))
    right = blocks.join(F.broadcast(crowds), "block").withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return left.select("query_id", "vector", "block", "turn").groupBy("block", "turn").cogroup(right.select("row_id", "vector", "block", "turn").groupBy("block", "turn")).applyInPandas(
        _compare(k), f"query_id {kind}, row_id bigint, distance double")


def nearest_rows(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """Exact k nearest `rows` (row_id, vector) of each of `queries` (query_id, vector), with ranks from 1.

    Rows lie in blocks around pivots (see `visits`); a query meets the blocks that may hold one
    of its k nearest. Every block and its visitors are matrix products, of which each query
    keeps at most k rows. A rank limit, applied before the last shuffle too, leaves the k best.
    Ties go to the lower row id. Vectors are not null and of one length.
    """
    kind = queries.schema["query_id"].dataType.simpleString()
    as_doubles = F.col("vector").cast("array<double>").alias("vector")
    queries, rows = queries.select("query_id", as_doubles), rows.select("row_id", as_doubles)
    if rows.count() <= BLOCK:  # one block, which every query visits
        asked, blocks = (df.withColumn("block", F.lit(0)) for df in (queries, rows))
    else:
        asked, blocks, _ = visits(cut(queries), cut(rows), k)
    order = Window.partitionBy("query_id").orderBy("distance", "row_id")
    return _tiles(asked, blocks, k, kind).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
