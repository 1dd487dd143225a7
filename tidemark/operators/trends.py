"""Traffic, sales and power summaries. All are hash aggregates with map-side combine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.scalars import month_start, weekday_sun0


def recent(df: DataFrame, ts: str, seconds: int, now: Column | None = None) -> DataFrame:
    """Rows newer than ``seconds`` before ``now`` (default: the current time)."""
    now = F.current_timestamp() if now is None else now
    return df.filter(F.col(ts) > now - F.expr(f"INTERVAL {int(seconds)} SECONDS"))


def traffic_by_window(df: DataFrame, ts: str, width: str, by: str) -> DataFrame:
    """Row count per tumbling window and ``by``."""
    return (df.groupBy(F.window(ts, width).alias("w"), by).agg(F.count("*").alias("c"))
              .select("w.start", "w.end", "c", by))


def count_by(df: DataFrame, key: str, name: str = "count") -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias(name))


def sum_by(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.sum(value).alias(name))


def top_users(df: DataFrame, user: str, n: int = 10) -> DataFrame:
    """The ``n`` most active users; equal counts are ordered by user."""
    return count_by(df, user).orderBy(F.desc("count"), F.asc(user)).limit(n)


def trend_by_year(df: DataFrame, day: str, value: str) -> DataFrame:
    return df.groupBy(F.year(day).alias("year")).agg(F.sum(value).alias("sales")).orderBy("year")


def trend_by_month(df: DataFrame, day: str, value: str) -> DataFrame:
    return (df.groupBy(month_start(day).alias("month")).agg(F.sum(value).alias("sales"))
              .orderBy("month"))


def seasonality_by_weekday(df: DataFrame, day: str, value: str) -> DataFrame:
    """Mean daily total per year and weekday (Sunday = 0)."""
    daily = df.groupBy(F.to_date(day).alias("day")).agg(F.sum(value).alias("total"))
    return (daily.groupBy(F.year("day").alias("year"), weekday_sun0("day").alias("weekday"))
                 .agg(F.avg("total").alias("sales"))
                 .orderBy("year", "weekday"))


def total_by_day(df: DataFrame, ts: str, value: str, name: str) -> DataFrame:
    """Sum per calendar day (grouped by the day, not by the raw timestamp)."""
    return df.groupBy(F.to_date(ts).alias("day")).agg(F.sum(value).alias(name))
