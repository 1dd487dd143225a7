"""Shapley values of a boosted-tree model for every row of a table.

A feature that is left out sends a row down both branches, weighted by the training rows
that the tree's nodes counted (path-dependent tree explanation, Lundberg et al. 2020). No
background rows are needed. For a leaf only the features on its path matter, and of a row
only which of their intervals it meets, so each leaf has a small table of values by that
pattern. Rows between the same cuts have the same values, which are worked out once.
No shuffle: rows are scored where they are.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import factorial, prod
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.session import scratch_dir

CELLS = 1 << 16  # of a table of values, at most


class Leaf(NamedTuple):
    """Value of a leaf; of each feature on its path the open-closed interval and the share
    of training rows that its splits send this way."""

    value: float
    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray


def model_leaves(spark: SparkSession, model) -> list[Leaf]:
    """Leaves of a fitted boosted-tree model, read from its saved node table."""
    path = scratch_dir(spark, "trees")
    model.write().save(path)
    trees: dict[int, dict[int, object]] = {}
    for row in spark.read.parquet(f"{path}/data").collect():
        trees.setdefault(row["treeID"], {})[row["nodeData"]["id"]] = row["nodeData"]
    leaves = []
    for number, nodes in trees.items():
        stack = [(0, {})]
        while stack:
            at, box = stack.pop()
            node = nodes[at]
            if node["leftChild"] < 0:
                used = sorted(box)
                leaves.append(Leaf(node["prediction"] * model.treeWeights[number], np.array(used, dtype=int),
                                   *[np.array([box[f][i] for f in used]) for i in range(3)]))
                continue
            split = node["split"]
            feature, cut = split["featureIndex"], split["leftCategoriesOrThreshold"][0]
            low, high, share = box.get(feature, (-np.inf, np.inf, 1.0))
            part = lambda child: share * nodes[child]["rawCount"] / node["rawCount"]
            left, right = node["leftChild"], node["rightChild"]
            stack.append((left, {**box, feature: (low, min(high, cut), part(left))}))
            stack.append((right, {**box, feature: (max(low, cut), high, part(right))}))
    return leaves


def _inside(x: np.ndarray, leaf: Leaf) -> np.ndarray:
    picked = x[:, leaf.features]
    return (picked > leaf.low) & (picked <= leaf.high)


def _order_weights(n: int) -> np.ndarray:
    """Share of the orders of ``n`` features in which a given set of k of them comes first, just before a given one."""
    return np.array([factorial(k) * factorial(n - k - 1) / factorial(n) for k in range(n)])


def leaf_table(leaf: Leaf) -> np.ndarray:
    """Shapley values of the leaf's features (columns) for each pattern of met intervals (rows)."""
    n = len(leaf.features)
    weights = _order_weights(n)
    out = np.zeros((1 << n, n))
    for pattern in range(1 << n):
        met = np.array([pattern >> i & 1 for i in range(n)], float)
        for i in range(n):
            by_size = np.zeros(n)
            by_size[0] = 1.0
            for j in range(n):  # products over the other features, by how many are known
                if j != i:
                    by_size[1:] = by_size[1:] * leaf.share[j] + by_size[:-1] * met[j]
                    by_size[0] *= leaf.share[j]
            out[pattern, i] = leaf.value * (weights @ by_size) * (met[i] - leaf.share[i])
    return out


def prepare(leaves: Sequence[Leaf]) -> tuple[list[tuple[Leaf, np.ndarray]], float]:
    """Each leaf with its table, and the base value: the mean margin over the training rows."""
    return [(leaf, leaf_table(leaf)) for leaf in leaves if len(leaf.features)], sum(leaf.value * leaf.share.prod() for leaf in leaves)


def explain(x: np.ndarray, tables: Sequence[tuple[Leaf, np.ndarray]]) -> np.ndarray:
    """Shapley values: those of a row sum to its margin minus the base."""
    phi = np.zeros(x.shape)
    for leaf, values in tables:
        pattern = _inside(x, leaf) @ (1 << np.arange(len(leaf.features)))
        phi[:, leaf.features] += values[pattern]
    return phi


def _cuts(tables: Sequence[tuple[Leaf, np.ndarray]], n: int) -> list[np.ndarray]:
    """Per feature the ends of the leaves' intervals, in order."""
    ends: list[set[float]] = [set() for _ in range(n)]
    for leaf, _ in tables:
        for f, low, high in zip(leaf.features, leaf.low, leaf.high):
            ends[f] |= {low, high}
    return [np.array(sorted(e - {-np.inf, np.inf})) for e in ends]


def cell_tables(tables: Sequence[tuple[Leaf, np.ndarray]], n: int, limit: int = CELLS) -> list[tuple[list[np.ndarray], np.ndarray | None, Sequence]]:
    """Values for all rows between the same cuts, worked out once: cuts, values per cell, leaves.

    Leaves whose cuts make more than ``limit`` cells are halved; a single one of that kind has no cells.
    """
    cuts = _cuts(tables, n)
    shape = [len(c) + 1 for c in cuts]
    if prod(shape) > limit:
        if len(tables) == 1:
            return [(cuts, None, tables)]
        half = len(tables) // 2
        return cell_tables(tables[:half], n, limit) + cell_tables(tables[half:], n, limit)
    # A cut belongs to the interval below it, so it stands for that; beyond the last one stands infinity.
    points = np.meshgrid(*[np.append(c, np.inf) for c in cuts], indexing="ij")
    return [(cuts, explain(np.stack([p.ravel() for p in points], axis=1), tables), tables)]


def explain_cells(x: np.ndarray, parts: Sequence[tuple[list[np.ndarray], np.ndarray | None, Sequence]]) -> np.ndarray:
    """``explain`` by cells: one look-up a row and part instead of one a row and leaf."""
    phi = np.zeros(x.shape)
    for cuts, values, tables in parts:
        if values is None:
            phi += explain(x, tables)
            continue
        cell = np.zeros(len(x), np.int64)
        for f, cut in enumerate(cuts):
            if len(cut):
                cell = cell * (len(cut) + 1) + np.searchsorted(cut, x[:, f], "left")
        phi += values[cell]
    return phi


def shapley(df: DataFrame, model, features: Sequence[str], vector: str = "features", keep: Sequence[str] = ()) -> DataFrame:
    """``<feature>_shap`` for every row plus ``base``; ``vector`` is the model's input column."""
    tables, base = prepare(model_leaves(df.sparkSession, model))
    parts = cell_tables(tables, len(features)) if tables else []
    names = [f"{f}_shap" for f in features]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(c, T.DoubleType()) for c in [*names, "base"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("_x").flatten().to_numpy().reshape(batch.num_rows, len(features))
            phi = explain_cells(x, parts)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *[pa.array(c) for c in phi.T], pa.array(np.full(len(x), base))],
                                             [*keep, *names, "base"])

    return df.select(*keep, vector_to_array(vector).alias("_x")).mapInArrow(run, schema)
