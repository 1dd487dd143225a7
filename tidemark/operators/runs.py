"""Choosing among logged experiment runs (rows with a ``metrics`` map)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.scalars import metric


def leaderboard(runs: DataFrame, rank_by: str = "F1", show: tuple[str, ...] = ("auc", "F1")) -> DataFrame:
    """Finished runs with the chosen metrics, best first."""
    shown = [metric("metrics", m).alias(m) for m in show]
    return (runs.filter("status = 'FINISHED'")
                .orderBy(metric("metrics", rank_by).desc_nulls_last(), "run_id")
                .select("experiment_id", "run_id", *shown, "artifact_uri"))


def best_run(runs: DataFrame, rank_by: str = "F1") -> DataFrame:
    """The finished run with the highest positive metric."""
    return (runs.filter("status = 'FINISHED'").filter(metric("metrics", rank_by) > 0)
                .orderBy(metric("metrics", rank_by).desc(), "run_id").limit(1))
