"""Sessions over a click stream: closed sessions, and online/offline status."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def sessions_stream(df: DataFrame, user: str, ts: str, gap: str, delay: str,
                    counters: dict[str, Column] | None = None) -> DataFrame:
    """Sessions that the watermark has closed, without clicks of no user. All native; the default choice.

    ``spark.sql.sessionWindow.merge.sessions.in.local.partition`` (set by
    ``build_session``) merges a hot user's clicks before the shuffle.
    """
    sums = [F.sum(expr).alias(name) for name, expr in (counters or {}).items()]
    closed = (df.withWatermark(ts, delay).filter(F.col(user).isNotNull())
                .groupBy(user, F.session_window(ts, gap).alias("_session"))
                .agg(F.min(ts).alias("start"), F.max(ts).alias("end"), F.count("*").alias("clicks"), *sums))
    return closed.drop("_session")


def abandoned_stream(df: DataFrame, user: str, ts: str, gap: str, delay: str, purchase: Column) -> DataFrame:
    """Alerts: closed sessions in which nothing was bought."""
    bought = {"purchases": F.when(purchase, 1).otherwise(0)}
    return sessions_stream(df, user, ts, gap, delay, bought).filter("purchases = 0").drop("purchases")


def abandoned_rate_stream(df: DataFrame, user: str, ts: str, gap: str, delay: str, purchase: Column, width: str) -> DataFrame:
    """``start, end, sessions, abandoned``: sessions by the window their end falls in, and those in which nothing was bought.

    A second stateful step on the first one's output under the same watermark: a session is
    counted when it has closed, a window appears when no session can close in it any more.
    """
    purchases = F.count_if(purchase).alias("purchases")
    sessions = (df.withWatermark(ts, delay).filter(F.col(user).isNotNull())
                  .groupBy(user, F.session_window(ts, gap).alias("_session")).agg(purchases))
    closed = sessions.groupBy(F.window(F.window_time("_session"), width).alias("w")).agg(
        F.count("*").alias("sessions"), F.count_if(F.col("purchases") == 0).alias("abandoned"))
    return closed.select("w.start", "w.end", "sessions", "abandoned")


def fold_sessions(open_: list[tuple[int, int, int]], new: list[tuple[int, int, int]],
                  gap: int) -> list[tuple[int, int, int]]:
    """Merge (start, end, clicks) spans whose pause is at most ``gap``."""
    out: list[tuple[int, int, int]] = []
    for start, end, clicks in sorted(open_ + new):
        if out and start <= out[-1][1] + gap:
            first, last, n = out[-1]
            out[-1] = (first, max(last, end), n + clicks)
        else:
            out.append((start, end, clicks))
    return out


def _combine(gap_us: int):
    """Stateless pre-aggregation: one span per user and gap-wide bucket of an Arrow batch."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            spans = (pdf.assign(bucket=pdf["us"] // gap_us).groupby(["user", "bucket"], sort=False)["us"]
                        .agg(["min", "max", "count"]).reset_index())
            yield pd.DataFrame({"user": spans["user"], "start_us": spans["min"], "end_us": spans["max"],
                                "clicks": spans["count"]})
    return run


def folded_clicks(df: DataFrame, user: str, ts: str, gap_us: int, delay: str, user_type: str) -> DataFrame:
    """``user, start_us, end_us, clicks, seen``: clicks folded per Arrow batch, under a watermark on ``seen``.

    Times cross into Python as epoch microseconds, whatever the session's time zone.
    """
    return (df.select(F.col(user).alias("user"), F.unix_micros(F.col(ts).cast("timestamp")).alias("us"))
              .filter("user IS NOT NULL AND us IS NOT NULL")
              .mapInPandas(_combine(gap_us), f"user {user_type}, start_us long, end_us long, clicks long")
              .withColumn("seen", F.timestamp_micros("end_us"))
              .withWatermark("seen", delay))


#: Users share a state by hash, so that a batch starts Python once per bucket and not once per user.
BUCKETS = 1024


def bucketed(spans: DataFrame) -> DataFrame:
    """``folded_clicks`` with the bucket of the user."""
    return spans.withColumn("bucket", F.pmod(F.xxhash64("user"), F.lit(BUCKETS)).cast("int"))


def merged_spans(open_: pd.DataFrame | None, new: pd.DataFrame, gap: int) -> pd.DataFrame:
    """``fold_sessions`` for many users at once: ``user, start_us, end_us, clicks`` and whether ``new`` touched the span."""
    both = new[["user", "start_us", "end_us", "clicks"]].assign(touched=True)
    if open_ is not None and len(open_):
        both = pd.concat([open_, both], ignore_index=True)
    code = pd.factorize(both["user"])[0]
    order = np.lexsort((both["start_us"].to_numpy(), code))
    both, code = both.iloc[order], code[order]
    reach = both["end_us"].groupby(code).cummax().to_numpy()
    start = both["start_us"].to_numpy()
    opens = np.ones(len(both), bool)
    opens[1:] = (code[1:] != code[:-1]) | (start[1:] > reach[:-1] + gap)
    at = np.flatnonzero(opens)
    out = both.iloc[at].reset_index(drop=True)
    out["end_us"] = np.maximum.reduceat(both["end_us"].to_numpy(), at)
    out["clicks"] = np.add.reduceat(both["clicks"].to_numpy(), at)
    out["touched"] = np.logical_or.reduceat(both["touched"].to_numpy(), at)
    return out


def session_status(df: DataFrame, user: str, ts: str, gap_seconds: int, delay: str,
                   user_type: str = "string") -> DataFrame:
    """An ``online`` row for every session a batch touches and one ``offline`` row at its end.

    The state of a bucket of users holds the spans the watermark has not closed, so clicks out
    of order still land in the right session; a span is dropped once it is offline.
    Clicks are folded per Arrow batch before the shuffle, so a hot user ships
    spans, not clicks.
    """
    gap = gap_seconds * 1_000_000
    columns = ["user", "start_us", "end_us", "clicks"]

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        spans = pd.DataFrame(dict(zip(columns, state.get))).assign(touched=False) if state.exists else None
        if not state.hasTimedOut:
            for pdf in batches:
                spans = merged_spans(spans, pdf, gap) if len(pdf) else spans
        if spans is None:
            return
        watermark = state.getCurrentWatermarkMs() * 1000
        ended = spans["end_us"] + gap <= watermark
        still = spans[~ended]
        if len(still):
            state.update(tuple(still[c].tolist() for c in columns))
            # Timeouts have millisecond grain: round up, never fire early.
            wake = -(-(int(still["end_us"].min()) + gap) // 1000)
            state.setTimeoutTimestamp(max(wake, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        yield pd.concat([still[still["touched"]].assign(status="online"), spans[ended].assign(status="offline")])[
            ["user", "status", "start_us", "end_us", "clicks"]]

    status = bucketed(folded_clicks(df, user, ts, gap, delay, user_type)).groupBy("bucket").applyInPandasWithState(
        update, f"user {user_type}, status string, start_us long, end_us long, clicks long",
        f"users array<{user_type}>, starts array<long>, ends array<long>, clicks array<long>", "append", GroupStateTimeout.EventTimeTimeout)
    return status.select(F.col("user").alias(user), "status", F.timestamp_micros("start_us").alias("start"),
                         F.timestamp_micros("end_us").alias("end"), "clicks")
