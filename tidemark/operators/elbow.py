"""Clusterings for many k at once: one scan of the rows per round serves every model."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.operators.stats import minmax
from tidemark.session import materialize


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centre, and the squared distance to it."""
    near = ((centres * centres).sum(axis=1) - 2 * (x @ centres.T)).argmin(axis=1)
    away = x - centres[near]
    return near, (away * away).sum(axis=1)


def _first_centres(sample: np.ndarray, ks: Sequence[int], rounds: int = 10) -> dict[int, np.ndarray]:
    """Start centres from a sample: each model is the next smaller one, settled, and the farthest point from it."""
    centres, out = sample.mean(axis=0, keepdims=True), {}
    for k in range(1, max(ks) + 1):
        for _ in range(rounds):
            near, _ = _nearest(sample, centres)
            centres = np.array([sample[near == c].mean(axis=0) if (near == c).any() else centres[c] for c in range(len(centres))])
        if k in ks:
            out[k] = centres
        centres = np.vstack([centres, sample[_nearest(sample, centres)[1].argmax()]])
    return out


def scaled_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``x``: the columns scaled to 0..10 as one array, rows with a NULL left out; stored, as every round reads it."""
    known = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).dropna()
    return materialize(minmax(known, columns).select(F.array(*columns).alias("x")), "scaled")


def step(rows: DataFrame, models: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """One Lloyd step of every model in one scan: sums and counts per centre, and the cost.

    The driver receives one number per centre and dimension, whatever the number of rows.
    """
    dim = next(iter(models.values())).shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {k: np.zeros((k, dim + 2)) for k in models}
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy().reshape(-1, dim)
                for k, centres in models.items():
                    near, cost = _nearest(x, centres)
                    hits = (near[:, None] == np.arange(k)).astype(float)
                    total[k] += hits.T @ np.column_stack([x, np.ones(len(x)), cost])
        for k, sums in total.items():
            centre, place = np.divmod(np.arange(sums.size, dtype=np.int32), np.int32(dim + 2))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(sums.size, k, np.int32)), pa.array(centre), pa.array(place), pa.array(sums.ravel())],
                                             ["k", "centre", "place", "total"])

    found = rows.mapInArrow(run, "k int, centre int, place int, total double").groupBy("k", "centre", "place").agg(F.sum("total").alias("total"))
    total = {k: np.zeros((k, dim + 2)) for k in models}
    for r in found.collect():
        total[r["k"]][r["centre"], r["place"]] = r["total"]
    return {k: (t[:, :dim], t[:, dim], float(t[:, dim + 1].sum())) for k, t in total.items()}


def kmeans_models(df: DataFrame, columns: Sequence[str], ks: Sequence[int] = range(2, 10), rounds: int = 20, tolerance: float = 1e-3,
                  sample: int = 2000) -> dict[int, tuple[np.ndarray, float, int]]:
    """Centres on scaled columns, within-cluster squared distance and rows of a clustering for every k.

    Starts come from ``sample`` rows chosen by hash; costs and centres from all rows. Rounds stop
    when no centre of any model moves by more than ``tolerance``, or after ``rounds``. Models of an
    empty table are left out.
    """
    rows = scaled_rows(df, columns)
    some = rows.orderBy(F.xxhash64("x"), "x").limit(sample).toArrow()["x"]
    if not len(some):
        return {}
    models = _first_centres(some.combine_chunks().flatten().to_numpy().reshape(len(some), -1), list(ks))
    for _ in range(rounds):
        found, moved = step(rows, models), 0.0
        for k, (sums, counts, _) in found.items():
            fresh = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], models[k])
            moved, models[k] = max(moved, float(np.abs(fresh - models[k]).max())), fresh
        if moved <= tolerance:
            break
    return {k: (models[k], cost, int(counts.sum())) for k, (_, counts, cost) in step(rows, models).items()}


def kmeans_elbow(df: DataFrame, columns: Sequence[str], ks: Sequence[int] = range(2, 10)) -> DataFrame:
    """``k, cost, n``: within-cluster squared distance on scaled columns, and the rows, for every k."""
    found = kmeans_models(df, columns, ks)
    return df.sparkSession.createDataFrame([(k, cost, n) for k, (_, cost, n) in sorted(found.items())], "k int, cost double, n long")
