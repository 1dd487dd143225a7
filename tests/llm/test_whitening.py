"""Whitening against brute force in Python integers and numpy."""

import math
import random

import numpy as np
import pytest

from tidemark.llm import queries, whitening

SF = "/root/testdata/sf0.01"


def slow(rows, components=16):
    """rows: (id, vector) of one length; n, sums, covariance, {id: exact deviation}, {id: x}."""
    good = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    distinct = [list(x) for x in {tuple(x) for _, x in good}]
    n, dim = len(distinct), len(distinct[0])
    sums = [sum(x[d] for x in distinct) for d in range(dim)]
    centred = [[n * x[d] - sums[d] for d in range(dim)] for x in distinct]
    cov = np.array([[sum(c[a] * c[b] for c in centred) / n ** 3 for b in range(dim)] for a in range(dim)])
    return n, sums, cov, [(i, sum((n * a - s) ** 2 for a, s in zip(x, sums)), x) for i, x in good]


def agree(found, rows, components=16):
    n, sums, cov, good = slow(rows)
    value, vector = np.linalg.eigh(cov)
    value, vector = value[::-1], vector[:, ::-1]
    count = min(components, int((value > value[0] * 1e-12).sum()))
    by_id = {}
    for r in found:
        by_id.setdefault(r.vec_id, []).append(r)
    assert len(found) == count * len(good) and {r.n for r in found} == {n}
    assert all(abs(r.explained - value[r.component - 1] / value.sum()) < 1e-9 for r in found)
    assert len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-8
    sign = {}
    for i, deviation, x in good:
        centred = np.array([(n * a - s) / n for a, s in zip(x, sums)])
        wanted = centred @ vector[:, :count] / np.sqrt(value[:count])
        for r in by_id[i]:
            assert int(r.deviation) == deviation
            if abs(wanted[r.component - 1]) > 1e-3:
                sign.setdefault(r.component, np.sign(r.whitened / wanted[r.component - 1]))
            assert abs(r.whitened - sign.get(r.component, 1) * wanted[r.component - 1]) < 1e-6


def frame(spark, rows, kind="array<float>"):
    return spark.createDataFrame([(v, i, 7, 8) for i, v in rows], f"embedding {kind}, vec_id long, n int, x int")


def test_random_vectors_copies_and_bad_rows(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 6)) @ rng.normal(size=(6, 6))
    rows = [(i, np.float32(v).tolist()) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)]
    bad = [(2000, None), (2001, [None] + [0.0] * 5), (2002, [float("nan")] * 6), (2003, [float("-inf")] + [0.0] * 5), (2004, []), (2005, [1.0, 2.0])]
    agree(whitening.whiten(frame(spark, rows + bad), 4).collect(), rows, 4)


def test_large_values_stay_exact(spark):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1e7, 1e7) for _ in range(3)]) for i in range(70)]
    agree(whitening.whiten(frame(spark, rows, "array<double>")).collect(), rows)


def test_planes_and_weights_equal_products():
    rng = np.random.default_rng(8)
    x = rng.integers(0, 1000, (777, 5))
    x[:, 3] = 0
    bits = [int(v).bit_length() for v in x.max(axis=0)]
    got = {(a, b): v for a, b, v in whitening.weigh(whitening.common_bits(whitening.planes(x, bits)), bits)}
    product = x.T @ x
    assert all(got[a, b] == product[a, b] for a in range(5) for b in range(a, 5))
    assert [got[a, -1] for a in range(5)] == x.sum(axis=0).tolist()


def test_no_variance_and_empty_table(spark):
    same = frame(spark, [(1, [1.0, 2.0]), (None, [1.0, 2.0])])
    assert whitening.whiten(same).collect() == [] and whitening.whiten(same.limit(0)).collect() == []
    assert whitening.whiten(frame(spark, [(1, None)])).collect() == []
    line = [(1, [1.0, 2.0]), (None, [2.0, 4.0]), (1, [1.0, 2.0]), (2, [3.0, 6.0])]  # one component has variance
    found = whitening.whiten(frame(spark, line)).collect()
    assert len(found) == 4 and sorted(str(r.vec_id) for r in found) == ["1", "1", "2", "None"]
    assert all(math.isclose(r.explained, 1.0) and r.component == 1 for r in found)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_brute_force(spark, sf):
    path = f"/root/testdata/{sf}"
    found = queries.op12_whitening(spark, path)
    assert dict(found.dtypes)["deviation"] == "bigint" and dict(found.dtypes)["component"] == "int"
    agree(found.collect(), [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()])
