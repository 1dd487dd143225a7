"""Exact quantiles by narrowing histograms."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], bins: int = 4096) -> DataFrame:
    """``column, probability, value``: the smallest value that at least that share of the values does not exceed.

    Values are compared as doubles; NULL and values that are not finite do not count, and a column
    without values gives NULLs. Every pass counts the values of the ranges that still hold a wanted
    rank in ``bins`` bins each, and goes on with the bin that holds it, until that has a single
    value. The driver receives at most ``bins`` rows per column and probability and pass; a value
    that most rows share is one bin like any other.
    """
    value = {c: F.col(c).cast("double") for c in columns}
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    ends = df.agg(*[F.struct(*[f(F.when(finite(v), v)).alias(n) for n, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]).alias(c)
                    for c, v in value.items()]).first()
    found: dict[tuple[str, float], float | None] = {}
    open_: dict[tuple[str, float], tuple[int, float, float]] = {}
    for c in columns:
        for p in probabilities:
            n, lo, hi = ends[c]
            if not n or lo == hi:
                found[c, p] = lo
            else:
                open_[c, p] = (min(n, max(1, math.ceil(p * n))), lo, hi)
    while open_:
        ranges = sorted({(c, lo, hi) for (c, _), (_, lo, hi) in open_.items()})
        places = F.filter(F.array(*[_place(value[c], i, lo, hi, bins) for i, (c, lo, hi) in enumerate(ranges)]), lambda s: s["bin"].isNotNull())
        counted = df.select(F.inline(places)).groupBy("range", "bin").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        rows: dict[int, list] = {}
        for r in counted.collect():
            rows.setdefault(r["range"], []).append((r["bin"], r["n"], r["lo"], r["hi"]))
        for (c, p), (rank, lo, hi) in list(open_.items()):
            for _, n, low, high in sorted(rows[ranges.index((c, lo, hi))]):
                if rank <= n:
                    break
                rank -= n
            if low == high:
                found[c, p] = low
                del open_[c, p]
            else:
                open_[c, p] = (rank, low, high)
    data = [(c, float(p), found[c, p]) for c in columns for p in probabilities]
    return df.sparkSession.createDataFrame(data, "column string, probability double, value double")


def _place(v, number: int, lo: float, hi: float, bins: int):
    """Range, bin and value; the bin is NULL outside the range. Halves keep the width finite."""
    share = (v / 2 - F.lit(lo / 2)) / F.lit(hi / 2 - lo / 2)
    at = F.least(F.lit(bins - 1), F.floor(share * bins).cast("int"))
    return F.struct(F.lit(number).alias("range"), F.when(v.between(lo, hi), at).alias("bin"), v.alias("v"))
