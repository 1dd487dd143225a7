"""Whitened embeddings from an exact, bit-sliced scatter matrix.

Components become integers. Over the distinct vectors, each dimension is shifted to start at
zero and cut into bit planes; a plane is packed across rows, 64 to a word. The cross-product
of two dimensions is the sum, over pairs of their planes, of the count of bits set in both,
weighted with a power of two: ``AND``, population count, nothing is rounded. Tasks emit one
number per pair of dimensions, Spark adds them as decimals, and the driver centres the sums
as integers before the one division and ``eigh``.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize

SCALE, SHIFT = 64, 1_000_000
EXACT = "decimal(38,0)"


def quantised(vector: Column) -> Column:
    """floor(64 * x) + 1,000,000 of each component; null where a component is null, not finite or beyond a long."""
    wide = vector.cast("array<double>")
    steps = F.transform(wide, lambda x: F.when(F.abs(x) < float(1 << 56), F.try_add(F.floor(x * SCALE), F.lit(SHIFT))))
    return F.when(~F.coalesce(F.exists(steps, lambda x: x.isNull()), F.lit(True)), steps)


def matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(-1, dim)


def planes(shifted: np.ndarray, bits: list[int]) -> np.ndarray:
    """Bit planes of a rows x dimensions matrix: one row of 64-bit words per dimension and bit, lowest bit first."""
    n = len(shifted)
    out = np.zeros((sum(bits), -(-n // 64) * 8), np.uint8)
    at = 0
    for d, width in enumerate(bits):
        for b in range(width):
            packed = np.packbits((shifted[:, d] >> b) & 1 != 0)
            out[at, : len(packed)] = packed
            at += 1
    return out.view(np.uint64)


def common_bits(words: np.ndarray) -> np.ndarray:
    """For every pair of planes, the number of rows that have both bits set (upper triangle)."""
    out = np.zeros((len(words), len(words)), np.int64)
    for p in range(len(words)):
        out[p, p:] = np.bitwise_count(words[p] & words[p:]).sum(axis=1, dtype=np.int64)
    return out


def weigh(both: np.ndarray, bits: list[int]) -> Iterator[tuple[int, int, int]]:
    """``a, b, sum of products`` for each pair of dimensions a <= b; ``a, -1, sum`` for each dimension."""
    edge = np.concatenate([[0], np.cumsum(bits)])
    for a, width in enumerate(bits):
        yield a, -1, sum(int(both[edge[a] + i, edge[a] + i]) << i for i in range(width))
        for b in range(a, len(bits)):
            part = both[edge[a]: edge[a + 1], edge[b]: edge[b + 1]]
            if a == b:  # the lower triangle of a dimension with itself is its upper one
                part = np.triu(part) + np.triu(part, 1).T
            yield a, b, sum(int(part[i, j]) << (i + j) for i, j in np.argwhere(part).tolist())


class Whitening:
    """What every row needs: ``n``, shifts, shifted sums, projection, explained shares, identity error."""

    def __init__(self, n: int, low: list[int], sums: list[int], products: dict[tuple[int, int], int], components: int):
        dim = len(low)
        scatter = [[n * products[min(a, b), max(a, b)] - sums[a] * sums[b] for b in range(dim)] for a in range(dim)]
        self.covariance = np.array([[v / (n * n) for v in row] for row in scatter])
        value, vector = np.linalg.eigh(self.covariance)
        value, vector = value[::-1], vector[:, ::-1]
        spread = value > max(value.max(initial=0), 0) * dim * np.finfo(float).eps
        keep = np.flatnonzero(spread)[:components]
        vector = vector[:, keep]
        lead = np.abs(vector).argmax(axis=0)
        vector = vector * np.where(vector[lead, np.arange(len(keep))] < 0, -1.0, 1.0)
        self.n, self.low, self.sums = n, np.array(low, np.int64), sums
        trace = sum(scatter[a][a] for a in range(dim)) / (n * n)
        self.explained = value[keep] / trace if len(keep) else value[keep]
        self.projection = vector / np.sqrt(value[keep])
        self.error = 0.0

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sum`` exactly: int64 where that and the sum of its squares fit, Python integers beyond."""
        shifted = x - self.low
        reach = self.n * max(int(shifted.max(initial=0)), 1)
        if reach * reach * max(x.shape[1], 1) < 2 ** 63:
            return shifted * self.n - np.array(self.sums, np.int64)
        return shifted.astype(object) * self.n - np.array(self.sums, object)

    def whitened(self, deviation: np.ndarray) -> np.ndarray:
        return (deviation / self.n).astype(float) @ self.projection


def fit(rows: DataFrame, dim: int, components: int) -> Whitening | None:
    """Learn from the distinct vectors of ``rows(x)``, all of ``dim`` dimensions; None without rows.

    The driver receives three numbers per dimension, one per pair of dimensions and one per
    pair of components, whatever the number of rows.
    """
    distinct = materialize(rows.select("x").distinct(), "distinct-vectors")

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch, dim)
                low = x.min(axis=0) if low is None else np.minimum(low, x.min(axis=0))
                high = x.max(axis=0) if high is None else np.maximum(high, x.max(axis=0))
        if low is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), pa.array(low), pa.array(high)], ["a", "low", "high"])

    found = distinct.mapInArrow(bounds, "a int, low long, high long").groupBy("a").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    found = sorted(found.collect())
    if not found:
        return None
    low = [r.low for r in found]
    bits = [(r.high - r.low).bit_length() for r in found]
    shift = np.array(low, np.int64)

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, both = 0, np.zeros((sum(bits), sum(bits)), np.int64)
        for batch in batches:
            if batch.num_rows:
                n += batch.num_rows
                both += common_bits(planes(matrix(batch, dim) - shift, bits))
        if n:
            sums = [(-1, -1, n), *weigh(both, bits)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in sums], pa.int32()), pa.array([r[1] for r in sums], pa.int32()),
                 pa.array([Decimal(r[2]) for r in sums], pa.decimal128(38, 0))], ["a", "b", "total"])

    parts = distinct.mapInArrow(scatter, f"a int, b int, total {EXACT}").groupBy("a", "b").agg(F.sum("total").alias("total"))
    total = {(r.a, r.b): int(r.total) for r in parts.collect()}
    model = Whitening(total.pop((-1, -1)), low, [total.pop((a, -1)) for a in range(dim)], total, components)
    model.error = identity_error(distinct, dim, model)
    return model


def identity_error(distinct: DataFrame, dim: int, model: Whitening) -> float:
    """Largest entry of |covariance - identity| of the whitened distinct vectors, measured on them."""
    count = model.projection.shape[1]
    if not count:
        return 0.0

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((count + 1, count))
        for batch in batches:
            if batch.num_rows:
                w = model.whitened(model.deviations(matrix(batch, dim)))
                total += np.vstack([w.T @ w, w.sum(axis=0)])
        a, b = np.divmod(np.arange(total.size, dtype=np.int32), np.int32(count))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(total.ravel())], ["a", "b", "total"])

    total = np.zeros((count + 1, count))
    for r in distinct.mapInArrow(products, "a int, b int, total double").groupBy("a", "b").agg(F.sum("total").alias("total")).collect():
        total[r.a, r.b] = r.total
    mean = total[count] / model.n
    return float(np.abs(total[:count] / model.n - np.outer(mean, mean) - np.eye(count)).max())


def whiten(vectors: DataFrame, components: int = 16, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` per row and component.

    The fit list is each distinct quantised vector once, so copies do not pull the axes. Rows
    whose vector is null, empty, or holds null or non-finite components (or such of 2^56 and
    more) take no part, nor do vectors of another length than the most frequent one (of equally
    frequent ones the longest). Repeated rows are returned as often as they occur, null ids are
    kept. Components without variance give no rows, so a table of one distinct vector or an
    empty table gives none. ``deviation`` is exact, as ``decimal(38,0)``. Other columns are ignored.
    """
    ready = vectors.select(F.col(id_col).alias("vec_id"), quantised(F.col(vector_col)).alias("x")).where("x IS NOT NULL AND size(x) > 0")
    lengths = ready.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = lengths.dim if lengths else 0
    ready = ready.where(F.size("x") == dim)
    model = fit(ready, dim, components) if dim else None
    kind = ready.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation {EXACT}, whitened double, explained double, identity_error double"
    if model is None:
        return ready.sparkSession.createDataFrame([], schema)
    count = model.projection.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not count:
                continue
            deviation = model.deviations(matrix(batch, dim))
            square = (deviation * deviation).sum(axis=1)
            exact = pa.array([Decimal(int(v)) for v in square], pa.decimal128(38, 0))
            each = pa.array(np.repeat(np.arange(batch.num_rows), count))
            rows = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(each), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows)),
                 pa.array(np.full(rows * count, model.n)), exact.take(each), pa.array(model.whitened(deviation).ravel()),
                 pa.array(np.tile(model.explained, rows)), pa.array(np.full(rows * count, model.error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return ready.mapInArrow(run, schema)
