"""Click stream: sessions, status, traffic and top users. Users are ``events.user_id``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import sessions as S
from tidemark.operators import trends
from tidemark.plans.common import folders, replay, stream_session, table
from tidemark.sources.files import stream_files, stream_table
from tidemark.streaming import heavy, live, session_state, sessions as stream_sessions, sinks

# Clicks of one user in the test data are hours apart.
GAP, GAP_SECONDS, DELAY = "6 hours", 6 * 3600, "1 hour"
SPLIT = "2024-01-16"
DELIVERIES = ["2024-01-08", "2024-01-16", "2024-01-23 12:00:00"]


def sessions_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.from_json("props", "k int")["k"]
    found = S.sessionize(table(spark, sf_dir, "events"), "user_id", "ts", GAP, {"sum_k": k})
    return found.select("user_id", "session_no", "start", "end", "clicks", "sum_k")


def sessions_native_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.sessions_by_window(table(spark, sf_dir, "events"), "user_id", "ts", GAP)


def abandoned_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    now = events.agg(F.max("ts").alias("now")).scalar()
    found = S.abandoned(events, "user_id", "ts", GAP, F.col("event_type") == "purchase", now)
    return found.select("user_id", "start", "end", "clicks")


def _clicks(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The click table in two parts, as it would arrive."""
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "ts")
    return [events.filter(F.col("ts") < SPLIT), events.filter(F.col("ts") >= SPLIT)]


def _click_stream(own: SparkSession, source: str) -> DataFrame:
    raw = stream_table(own, source, "user_id long, event_type string, ts timestamp_ntz")
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def _naive(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _run_clicks(spark: SparkSession, sf_dir: str, label: str, job) -> DataFrame:
    """Replay the clicks through ``job`` into Parquet and read the result."""
    own = stream_session(spark)
    source, out, checkpoint = folders(spark, label, "in", "out", "checkpoint")
    replay(_clicks(spark, sf_dir), source, lambda: sinks.sink_append(
        job(_click_stream(own, source)), out, checkpoint, available_now=True).awaitTermination())
    return spark.read.parquet(out)


def sessions_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_clicks(spark, sf_dir, "sessions", lambda clicks: _naive(
        stream_sessions.sessions_stream(clicks, "user_id", "ts", GAP, DELAY), "start", "end"))


def abandoned_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_clicks(spark, sf_dir, "abandoned", lambda clicks: _naive(stream_sessions.abandoned_stream(
        clicks, "user_id", "ts", GAP, DELAY, F.col("event_type") == "purchase"), "start", "end"))


def abandoned_rate_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per day the sessions that closed in it and those without a purchase, from two chained stateful steps."""
    return _run_clicks(spark, sf_dir, "rate", lambda clicks: _naive(stream_sessions.abandoned_rate_stream(
        clicks, "user_id", "ts", GAP, DELAY, F.col("event_type") == "purchase", "1 day"), "start", "end"))


def _status(clicks: DataFrame) -> DataFrame:
    return _naive(stream_sessions.session_status(clicks, "user_id", "ts", GAP_SECONDS, DELAY, "long"),
                  "start", "end")


def session_status_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_clicks(spark, sf_dir, "status", _status)


def session_offline_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_status_stream(spark, sf_dir).filter("status = 'offline'")


def _deliveries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The clicks in four deliveries by time: all status rows, and the open spans after each delivery."""
    own = stream_session(spark)
    own.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))  # each partition starts a Python worker per batch
    source, out, checkpoint, state = folders(spark, "updates", "in", "out", "checkpoint", "state")
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "ts")
    edges = [None, *DELIVERIES, None]
    for n, (start, stop) in enumerate(zip(edges, edges[1:])):
        part = events if start is None else events.filter(F.col("ts") >= start)
        (part if stop is None else part.filter(F.col("ts") < stop)).write.mode("append").parquet(source)
        updates = session_state.session_updates(_click_stream(own, source), "user_id", "ts", GAP_SECONDS, DELAY, "long")
        sinks.sink_append(_naive(updates, "start", "end"), out, checkpoint, available_now=True).awaitTermination()
        _naive(session_state.open_spans(own, checkpoint, "user_id"), "start", "end").write.parquet(f"{state}/delivery={n + 1}")
    return spark.read.parquet(out), spark.read.parquet(state)


def session_online_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The online rows: every span as it was after each delivery that touched it."""
    return _deliveries(spark, sf_dir)[0].filter("status = 'online'")


def session_closed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The offline rows that the timers gave."""
    return _deliveries(spark, sf_dir)[0].filter("status = 'offline'")


def session_state_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spans open after each delivery, read from the query's state."""
    return _deliveries(spark, sf_dir)[1]


def traffic_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_clicks(spark, sf_dir, "traffic", lambda clicks: _naive(
        live.live_traffic(clicks, "ts", "1 hour", "event_type", DELAY), "start", "end"))


def top_users_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = stream_session(spark)
    source, out, checkpoint = folders(spark, "top", "in", "out", "checkpoint")
    events = table(spark, sf_dir, "events")
    events.repartition(3).write.parquet(source)  # three micro-batches: counts must live on between them
    stream = stream_files(own, source, "parquet", events.schema, max_files=1)
    sinks.sink_replace(live.live_top_users(stream, "user_id"), out, checkpoint, available_now=True).awaitTermination()
    return spark.read.parquet(out)


def top_users_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top users of a stream whose summary holds 1,000 users at most, counted exactly afterwards."""
    own = stream_session(spark)
    source, out, checkpoint = folders(spark, "heavy", "in", "out", "checkpoint")
    events = table(spark, sf_dir, "events").select("user_id", "ts")
    events.repartition(3).write.parquet(source)
    stream = stream_files(own, source, "parquet", events.schema, max_files=1)
    heavy.heavy_stream(stream, "user_id", out, checkpoint, available_now=True).awaitTermination()
    return heavy.exact_top(events, heavy.read_summary(spark, out), "user_id")


def traffic_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.traffic_by_window(table(spark, sf_dir, "events"), "ts", "10 seconds", "event_type")


def traffic_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traffic of the last three hours before the newest click."""
    events = table(spark, sf_dir, "events")
    now = events.agg(F.max("ts").alias("now")).scalar()
    return trends.traffic_by_window(trends.recent(events, "ts", 3 * 3600, now), "ts", "10 seconds", "event_type")


def clicks_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.count_by(table(spark, sf_dir, "events"), "user_id")


def top_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.top_users(table(spark, sf_dir, "events"), "user_id")


QUERIES = {f.__name__: f for f in (
    sessions_batch, sessions_native_window, abandoned_sessions, sessions_stream, abandoned_stream, abandoned_rate_stream,
    session_status_stream, session_offline_stream, session_online_stream, session_closed_stream, session_state_spans, traffic_stream, top_users_stream, top_users_bounded, traffic_tumbling, traffic_recent,
    clicks_per_user, top_users)}

_SESSIONS = """
WITH marked AS (
  SELECT *, CASE WHEN ts > lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 6 HOUR THEN 1 ELSE 0 END AS n
  FROM events),
numbered AS (
  SELECT *, 1 + sum(n) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session_no FROM marked),
sessions AS (
  SELECT user_id, CAST(session_no AS BIGINT) AS session_no, min(ts) AS start, max(ts) AS "end", count(*) AS clicks,
         CAST(sum(CAST(json_extract(props, '$.k') AS INTEGER)) AS BIGINT) AS sum_k,
         count(*) FILTER (WHERE event_type = 'purchase') AS purchases
  FROM numbered GROUP BY user_id, session_no)
"""


def _delivered(cuts: list[str]) -> str:
    """Sessions as they were after each of the deliveries that end at the cuts, with the delivery that touched them last."""
    ends = ", ".join(f"TIMESTAMP '{c}'" for c in cuts)
    return f"""
WITH parts AS (SELECT user_id, ts, 1 + len(list_filter([{ends}], lambda c: ts >= c)) AS part FROM events),
steps AS (SELECT unnest(range(1, {len(cuts) + 2})) AS delivery),
marked AS (
  SELECT delivery, user_id, ts, part,
         CASE WHEN ts > lag(ts) OVER (PARTITION BY delivery, user_id ORDER BY ts) + INTERVAL 6 HOUR THEN 1 ELSE 0 END AS n
  FROM parts JOIN steps ON part <= delivery),
numbered AS (
  SELECT *, sum(n) OVER (PARTITION BY delivery, user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session_no FROM marked),
clock AS (SELECT delivery, max(ts) - INTERVAL 1 HOUR AS watermark FROM marked GROUP BY 1),
spans AS (
  SELECT delivery, user_id, min(ts) AS start, max(ts) AS "end", count(*) AS clicks, max(part) AS touched
  FROM numbered GROUP BY delivery, user_id, session_no)
"""


_DELIVERED = _delivered(DELIVERIES)
_CLOSED = '"end" + INTERVAL 6 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR'
_TOP = "SELECT user_id, count(*) AS count FROM events GROUP BY user_id ORDER BY 2 DESC, 1 LIMIT 10"


def _traffic(width: str, where: str = "TRUE") -> str:
    bucket = f"time_bucket(INTERVAL {width}, ts, TIMESTAMP '1970-01-01')"
    return (f"SELECT {bucket} AS start, {bucket} + INTERVAL {width} AS \"end\", count(*) AS c, event_type "
            f"FROM events WHERE {where} GROUP BY 1, 2, event_type")


ORACLE = {
    "sessions_batch": _SESSIONS + 'SELECT user_id, session_no, start, "end", clicks, sum_k FROM sessions',
    "sessions_native_window": _SESSIONS + 'SELECT user_id, start, "end", clicks FROM sessions',
    "abandoned_sessions": _SESSIONS + """SELECT user_id, start, "end", clicks FROM sessions
        WHERE purchases = 0 AND "end" + INTERVAL 6 HOUR <= (SELECT max(ts) FROM events)""",
    "sessions_stream": _SESSIONS + f'SELECT user_id, start, "end", clicks FROM sessions WHERE {_CLOSED}',
    "abandoned_stream": _SESSIONS + f"""SELECT user_id, start, "end", clicks FROM sessions
        WHERE purchases = 0 AND {_CLOSED}""",
    "session_offline_stream": _SESSIONS + f"""SELECT user_id, 'offline' AS status, start, "end", clicks
        FROM sessions WHERE {_CLOSED}""",
    "abandoned_rate_stream": _SESSIONS + f"""SELECT * FROM (
        SELECT time_bucket(INTERVAL 1 DAY, "end" + INTERVAL 6 HOUR - INTERVAL 1 MICROSECOND) AS start,
               time_bucket(INTERVAL 1 DAY, "end" + INTERVAL 6 HOUR - INTERVAL 1 MICROSECOND) + INTERVAL 1 DAY AS "end",
               count(*) AS sessions, count(*) FILTER (WHERE purchases = 0) AS abandoned
        FROM sessions GROUP BY 1, 2) WHERE "end" <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
    "top_users_bounded": f"SELECT *, TRUE AS complete FROM ({_TOP})",
    "session_status_stream": _delivered([SPLIT]) + """SELECT user_id, 'online' AS status, start, "end", clicks
        FROM spans WHERE touched = delivery
        UNION ALL SELECT user_id, 'offline', start, "end", clicks FROM spans JOIN clock USING (delivery)
        WHERE delivery = 2 AND "end" + INTERVAL 6 HOUR <= watermark""",
    "session_online_stream": _DELIVERED + """SELECT user_id, 'online' AS status, start, "end", clicks
        FROM spans WHERE touched = delivery""",
    "session_closed_stream": _SESSIONS + f"""SELECT user_id, 'offline' AS status, start, "end", clicks
        FROM sessions WHERE {_CLOSED}""",
    "session_state_spans": _DELIVERED + """SELECT CAST(delivery AS INTEGER) AS delivery, user_id, start, "end", clicks
        FROM spans JOIN clock USING (delivery) WHERE "end" + INTERVAL 6 HOUR > watermark""",
    "traffic_stream": f"""SELECT * FROM ({_traffic('1 HOUR')})
        WHERE "end" <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
    "top_users_stream": _TOP,
    "traffic_tumbling": _traffic("10 SECOND"),
    "traffic_recent": _traffic("10 SECOND", "ts > (SELECT max(ts) FROM events) - INTERVAL 3 HOUR"),
    "clicks_per_user": "SELECT user_id, count(*) AS count FROM events GROUP BY user_id",
    "top_users": _TOP,
}
