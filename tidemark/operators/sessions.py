"""User sessions over full history.

A user with a third of all clicks must not end up in one task. Clicks are first
folded into tumbling buckets as wide as the gap: two clicks in one bucket are
always closer than the gap, so a bucket never spans two sessions. That fold is an
ordinary aggregate with map-side combine. What is left per user is at most
``time span / gap`` rows, whatever the number of clicks, and only those are put
in order to find the breaks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def activity_buckets(df: DataFrame, user: str, ts: str, gap: str,
                     counters: dict[str, Column] | None = None) -> DataFrame:
    """First and last click, click count and extra sums per user and bucket.

    A click without a user or a time belongs to no session, here and in the streams.
    """
    sums = [F.sum(expr).alias(name) for name, expr in (counters or {}).items()]
    return (df.filter(F.col(user).isNotNull() & F.col(ts).isNotNull()).groupBy(user, F.window(ts, gap)["start"].alias("_bucket"))
              .agg(F.min(ts).alias("start"), F.max(ts).alias("end"),
                   F.count("*").alias("clicks"), *sums)
              .drop("_bucket"))


def sessionize(df: DataFrame, user: str, ts: str, gap: str,
               counters: dict[str, Column] | None = None) -> DataFrame:
    """Sessions per user: a new one starts when the pause is longer than ``gap``.

    A pause of exactly ``gap`` keeps the session. ``counters`` adds summed
    measures, e.g. the number of purchases.
    """
    extra = list(counters or {})
    in_order = Window.partitionBy(user).orderBy("start")
    starts_new = F.col("start") > F.lag("end").over(in_order) + F.expr(f"INTERVAL {gap}")
    return (activity_buckets(df, user, ts, gap, counters)
            .withColumn("_new", F.when(starts_new, 1).otherwise(0))
            .withColumn("session_no", F.sum("_new").over(
                in_order.rowsBetween(Window.unboundedPreceding, 0)) + 1)
            .groupBy(user, "session_no")
            .agg(F.min("start").alias("start"), F.max("end").alias("end"),
                 *[F.sum(c).alias(c) for c in ["clicks", *extra]]))


def sessions_by_window(df: DataFrame, user: str, ts: str, gap: str) -> DataFrame:
    """The same sessions through ``session_window``, with a gap per bucket.

    A bucket from ``start`` to ``end`` is one event whose own gap reaches to
    ``end + gap``.
    """
    micros = F.timestamp_diff("MICROSECOND", F.col("start"), F.col("end") + F.expr(f"INTERVAL {gap}"))
    reach = F.make_interval(secs=(micros.cast("decimal(18,0)") / 1000000).cast("decimal(18,6)"))
    return (activity_buckets(df, user, ts, gap)
            .groupBy(user, F.session_window("start", reach).alias("_session"))
            .agg(F.min("start").alias("start"), F.max("end").alias("end"),
                 F.sum("clicks").alias("clicks"))
            .drop("_session"))


def closed(sessions: DataFrame, now: Column, gap: str) -> DataFrame:
    """Sessions whose user has been silent for ``gap`` at ``now``."""
    return sessions.filter(F.col("end") + F.expr(f"INTERVAL {gap}") <= now)


def abandoned(df: DataFrame, user: str, ts: str, gap: str, purchase: Column, now: Column) -> DataFrame:
    """Closed sessions in which nothing was bought."""
    bought = {"purchases": F.when(purchase, 1).otherwise(0)}
    return closed(sessionize(df, user, ts, gap, bought), now, gap).filter("purchases = 0").drop("purchases")
