"""Session status with named state: open spans as list state per bucket of users, with a timer, readable from outside.

The state of a query is a table: ``open_spans`` reads it from the checkpoint, also while the
query is stopped, to see who is online at the last committed batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from tidemark.streaming.sessions import bucketed, folded_clicks, merged_spans

SPANS = "spans"
SPAN = "start_us long, end_us long, clicks long"
COLUMNS = ["user", "start_us", "end_us", "clicks"]
ROWS = ["user", "status", "start_us", "end_us", "clicks"]


def fires(end_us: int, gap_us: int) -> int:
    """When a span's timer is due, in milliseconds, never early."""
    return -(-(end_us + gap_us) // 1000)


class SessionProcessor(StatefulProcessor):
    """Folds the clicks of a bucket of users into open spans; a timer closes those that are due.

    A batch that touches a span gives an ``online`` row with the span as it is then. The bucket
    has one timer, due when the first of its open spans is; it gives the ``offline`` rows, drops
    these spans and is set to the next one.
    """

    def __init__(self, gap_us: int, user_type: str):
        self.gap_us, self.user_type = gap_us, user_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.spans = handle.getListState(SPANS, f"users array<{self.user_type}>, starts array<long>, ends array<long>, clicks array<long>")

    def _open(self) -> pd.DataFrame | None:
        held = next(iter(self.spans.get()), None) if self.spans.exists() else None
        return None if held is None else pd.DataFrame(dict(zip(COLUMNS, held))).assign(touched=False)

    def _keep(self, spans: pd.DataFrame) -> None:
        if len(spans):
            self.spans.put([tuple(spans[c].tolist() for c in COLUMNS)])  # one entry of arrays: an entry per span costs a call each
        else:
            self.spans.clear()

    def _due(self, spans: pd.DataFrame | None) -> int | None:
        return None if spans is None or not len(spans) else fires(int(spans["end_us"].min()), self.gap_us)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        before = self._open()
        after = before
        for pdf in rows:
            after = merged_spans(after, pdf, self.gap_us) if len(pdf) else after
        if after is None:
            return
        old, new = self._due(before), self._due(after)
        if old != new:
            if old is not None:
                self.handle.deleteTimer(old)
            self.handle.registerTimer(new)
        self._keep(after)
        yield after[after["touched"]].assign(status="online")[ROWS]

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        until = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        spans = self._open()
        if spans is None:
            return
        due = spans["end_us"] + self.gap_us <= until * 1000
        still = spans[~due]
        self._keep(still)
        if len(still):
            self.handle.registerTimer(self._due(still))
        yield spans[due].assign(status="offline")[ROWS]


def session_updates(df: DataFrame, user: str, ts: str, gap_seconds: int, delay: str, user_type: str = "string") -> DataFrame:
    """``user, status, start, end, clicks``: an ``online`` row for every span a batch touches, one ``offline`` row at its end.

    Clicks of no user or no time are left out, late ones by the watermark. Clicks are folded per
    Arrow batch before the shuffle, so a hot user ships spans, not clicks, and keeps open spans
    only. Needs the RocksDB state store (``build_session`` sets it).
    """
    gap_us = gap_seconds * 1_000_000
    spans = bucketed(folded_clicks(df, user, ts, gap_us, delay, user_type))
    found = spans.groupBy("bucket").transformWithStateInPandas(
        SessionProcessor(gap_us, user_type), f"user {user_type}, status string, {SPAN}", "append", "eventtime")
    return found.select(F.col("user").alias(user), "status", F.timestamp_micros("start_us").alias("start"),
                        F.timestamp_micros("end_us").alias("end"), "clicks")


def open_spans(spark: SparkSession, checkpoint: str, user: str, batch: int | None = None) -> DataFrame:
    """``user, start, end, clicks``: the spans that are open after the last (or the given) committed batch."""
    reader = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", SPANS)
    state = (reader if batch is None else reader.option("batchId", batch)).load()
    held = F.col("list_element")
    spans = state.select(F.explode(F.arrays_zip(*[held[c].alias(c) for c in ("users", "starts", "ends", "clicks")])).alias("span"))
    return spans.select(F.col("span.users").alias(user), F.timestamp_micros("span.starts").alias("start"),
                        F.timestamp_micros("span.ends").alias("end"), F.col("span.clicks").alias("clicks"))
