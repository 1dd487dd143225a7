"""Data profiling. Results are small and in long form."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.quantiles import exact_quantiles
from tidemark.session import materialize


def _long(wide: DataFrame, rows: Sequence[Sequence[tuple[str, Column]]]) -> DataFrame:
    """Unfold a one-row aggregate: each entry of ``rows`` is one output row."""
    structs = [F.struct(*[value.alias(name) for name, value in row]) for row in rows]
    return wide.select(F.inline(F.array(*structs)))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("count"))


def summary_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, stddev, min, exact quartiles and max per column.

    The quartiles take some more passes over the rows, see ``exact_quantiles``.
    """
    aggs = []
    for c in columns:
        aggs += [F.count(c).alias(f"{c}_n"), F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_sd"),
                 F.min(c).cast("double").alias(f"{c}_min"), F.max(c).cast("double").alias(f"{c}_max")]
    quartiles = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    at = {(r["column"], r["probability"]): r["value"] for r in exact_quantiles(df, columns, list(quartiles.values())).collect()}
    rows = [[("column", F.lit(c)), ("count", F.col(f"{c}_n")), ("mean", F.col(f"{c}_mean")),
             ("stddev", F.col(f"{c}_sd")), ("min", F.col(f"{c}_min")),
             *[(name, F.lit(at[c, p]).cast("double")) for name, p in quartiles.items()],
             ("max", F.col(f"{c}_max"))] for c in columns]
    return _long(df.agg(*aggs), rows)


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, missing)."""
    columns = list(columns or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _long(wide, [[("column", F.lit(c)), ("missing", F.col(c))] for c in columns])


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Keep the columns without any NULL. The check returns one row to the driver."""
    flags = df.agg(*[F.bool_or(F.col(c).isNull()).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if not flags[c]])


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, r) for every ordered pair; each unordered pair is computed once."""
    pairs = list(combinations_with_replacement(columns, 2))
    wide = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    rows = []
    for a, b in pairs:
        for x, y in {(a, b), (b, a)}:
            rows.append([("a", F.lit(x)), ("b", F.lit(y)), ("r", F.col(f"`{a}|{b}`"))])
    return _long(wide, rows)


def class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Add a weight of one over the size of the row's class; NULL where the label is NULL.

    The class sizes are a stored table, so that Spark knows its size: it broadcasts it where it
    is small and leaves the rows where they are, and splits those of a hot label where it is not.
    """
    sizes = df.filter(F.col(label).isNotNull()).groupBy(label).agg((F.lit(1.0) / F.count("*")).alias(name))
    sizes = materialize(sizes, "class-sizes")
    return df.join(sizes, label, "left").select(*[F.col(c) for c in df.columns], name)


def minmax(df: DataFrame, columns: Sequence[str], lo: float = 0.0, hi: float = 10.0) -> DataFrame:
    """Scale columns to ``[lo, hi]``; a constant column becomes ``lo``."""
    ends = df.agg(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in columns])
    ends = ends.select(F.struct(*columns).alias("e")).scalar()
    scaled = {}
    for c in columns:
        low, high = ends[c]["lo"], ends[c]["hi"]
        share = F.when(high == low, F.lit(0.0)).otherwise((F.col(c) - low) / (high - low))
        scaled[c] = share * (hi - lo) + lo
    return df.select(*[scaled[c].alias(c) if c in scaled else F.col(c) for c in df.columns])


def cluster_profile(df: DataFrame, cluster: str, columns: Sequence[str]) -> DataFrame:
    """Mean of each column per cluster."""
    return df.groupBy(cluster).agg(*[F.avg(c).alias(c) for c in columns])
