"""Top-k search against brute force."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import topk


def slow_search(rows, k=5):
    """rows: (id, vector); queries are the ids divisible by 5."""
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, v in {(i, tuple(v)) for i, v in good if i % 5 == 0}:
        found = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q and len(w) == len(v))
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(found[:k])}
    return out


def run(spark, rows, kind="array<float>"):
    frame = spark.createDataFrame([(i, v, 9) for i, v in rows], f"vec_id long, embedding {kind}, rank int")
    return topk.search(frame, F.col("vec_id") % 5 == 0)


def test_ties_bad_vectors_and_lengths(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-1.0, -0.5, 0.0, 0.25, 1.0]) for _ in range(4)]) for i in range(60)]
    rows += [(100 + i, [1.0, 1.0, 1.0, 1.0]) for i in range(40)] + [(200, None), (205, [1.0, None, 0.0, 0.0]), (210, [float("nan"), 0.0, 0.0, 0.0])]
    rows += [(215, [float("inf")] * 4), (220, [0.5, 0.5]), (221, [0.5, -0.5]), (None, [1.0] * 4), (225, []), (230, [0.0] * 4)]
    found = [tuple(r) for r in run(spark, rows).collect()]
    assert len(found) == len(set(found)) and set(found) == slow_search(rows)


def test_large_values_stay_exact(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-4e6, 4e6) for _ in range(3)]) for i in range(50)]
    assert {tuple(r) for r in run(spark, rows, "array<double>").collect()} == slow_search(rows)


def test_repeated_rows_and_empty_table(spark):
    rows = [(5, [1.0, 0.0]), (5, [1.0, 0.0]), (6, [0.5, 0.5]), (6, [0.5, 0.5])]
    assert sorted(tuple(r) for r in run(spark, rows).collect()) == [(5, 1, 6, 256 * 128), (5, 2, 6, 256 * 128)]
    assert run(spark, rows).limit(0).collect() == [] and run(spark, [(5, [1.0])]).collect() == []


def test_many_shards(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 7)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).round(2).tolist()) for i in range(300)]
    assert {tuple(r) for r in run(spark, rows).collect()} == slow_search([(i, np.array(v, np.float32).tolist()) for i, v in rows])


def test_threshold_stops_early():
    rng = np.random.default_rng(5)
    matrix = rng.integers(-3, 4, (2000, 3))
    matrix[:6] = 200
    shard = topk.Shard(np.arange(2000), matrix)
    best, scored = shard.search(np.array([5, 4, 3]), 0, 5, [])
    assert [i for _, i in best] == [1, 2, 3, 4, 5] and scored < 200


def test_threshold_is_exact_for_large_components():
    large = 1 << 20
    query = np.array([large, 1, 1])
    rows = [[large, 5, 5]] + [[large, 6, 0]] * 9 + [[large, 0, 6]] * 9 + [[large, 0, 0]] * 30
    found, _ = topk.Shard(np.arange(len(rows)), np.array(rows)).search(query, -1, 5, [])
    assert found == sorted((-int(query @ np.array(r)), i) for i, r in enumerate(rows))[:5]
    rng = np.random.default_rng(4)
    rows = large - rng.integers(0, 40, (3000, 64))
    shard = topk.Shard(np.arange(3000), rows)
    for query in large - rng.integers(0, 1 << 10, (20, 64)):
        assert shard.search(query, -1, 5, [])[0] == sorted(zip((-(rows @ query)).tolist(), range(3000)))[:5]
