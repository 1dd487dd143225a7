"""Live aggregates. A watermark bounds the state of windowed counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.trends import traffic_by_window


def live_traffic(stream: DataFrame, ts: str, width: str, by: str, delay: str) -> DataFrame:
    """Row count per closed window; a window appears once the watermark has passed it."""
    return traffic_by_window(stream.withWatermark(ts, delay), ts, width, by)


def live_sum(stream: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Running sum per key (complete or update mode)."""
    return stream.groupBy(key).agg(F.sum(value).alias(name))


def live_top_users(stream: DataFrame, user: str, n: int = 10) -> DataFrame:
    """Running top users; sorted streams need complete mode."""
    counts = stream.groupBy(user).agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), F.asc(user)).limit(n)
