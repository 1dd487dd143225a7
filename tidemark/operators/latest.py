"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key under ``order``; give a tie-break as last entry.

    ``row_number() = 1`` makes Spark plan a group limit before the shuffle, so a
    map task ships at most one row per key and a hot key stays cheap.
    """
    newest = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rank", F.row_number().over(newest))
              .filter(F.col("_rank") == 1).drop("_rank"))


def latest_change(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Newest change row per key; pre-images are dropped before ranking."""
    kept = changes.filter(F.col("_change_type") != "update_preimage")
    return latest_per_key(kept, keys, [F.desc("_commit_version")])


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """One row per key: any row, or the first one under ``order``."""
    return latest_per_key(df, keys, order) if order else df.dropDuplicates(list(keys))
