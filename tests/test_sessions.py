import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import sessions as S
from tidemark.plans.common import folders
from tidemark.sources.files import stream_table
from tidemark.streaming import sessions as stream, sinks

T0 = dt.datetime(2024, 1, 1)


def clicks(spark, rows):
    """(user, seconds after T0) rows with a naive timestamp."""
    data = [(u, T0 + dt.timedelta(seconds=s)) for u, s in rows]
    return spark.createDataFrame(data, "user string, ts timestamp_ntz")


def brute(rows, gap):
    """Sessions as (user, first, last, clicks) in seconds."""
    out = []
    for user in {u for u, _ in rows}:
        for s in sorted(t for u, t in rows if u == user):
            if out and out[-1][0] == user and s - out[-1][2] <= gap:
                out[-1] = (user, out[-1][1], s, out[-1][3] + 1)
            else:
                out.append((user, s, s, 1))
    return sorted(out)


def seconds(value):
    return (value - T0).total_seconds()


def found(df):
    return sorted((r["user"], seconds(r["start"]), seconds(r["end"]), r["clicks"]) for r in df.collect())


def test_gap_of_exactly_the_limit_keeps_the_session(spark):
    rows = [("a", 0), ("a", 45), ("b", 0), ("b", 46)]
    wanted = [("a", 0, 45, 2), ("b", 0, 0, 1), ("b", 46, 46, 1)]
    df = clicks(spark, rows)
    assert found(S.sessionize(df, "user", "ts", "45 seconds")) == wanted
    assert found(S.sessions_by_window(df, "user", "ts", "45 seconds")) == wanted


def random_rows(seed, hot=400):
    """One user holds most of the clicks."""
    rng = random.Random(seed)
    rows = [("hot", rng.randrange(0, 20000) / 2) for _ in range(hot)]
    return rows + [(f"u{rng.randrange(5)}", rng.randrange(0, 3000)) for _ in range(60)]


@pytest.mark.parametrize("seed", range(3))
def test_batch_paths_equal_brute_force(spark, seed):
    rows = random_rows(seed)
    df = clicks(spark, rows).repartition(7)
    assert found(S.sessionize(df, "user", "ts", "45 seconds")) == brute(rows, 45)
    assert found(S.sessions_by_window(df, "user", "ts", "45 seconds")) == brute(rows, 45)


def test_times_before_the_epoch(spark):
    df = spark.createDataFrame([("a", dt.datetime(1969, 12, 31, 23, 59, 50)), ("a", dt.datetime(1970, 1, 1, 0, 0, 10))],
                               "user string, ts timestamp_ntz")
    assert S.sessionize(df, "user", "ts", "45 seconds").count() == 1


def test_hot_user_is_folded_before_any_ordering(spark):
    df = clicks(spark, [("hot", i % 600) for i in range(5000)])
    assert S.activity_buckets(df, "user", "ts", "45 seconds").count() <= 600 / 45 + 1


def test_abandoned(spark):
    df = clicks(spark, [("a", 0), ("a", 10), ("b", 0), ("c", 5000)]).withColumn(
        "kind", F.when(F.col("user") == "b", "purchase").otherwise("view"))
    now = F.lit("2024-01-01 00:01:40").cast("timestamp_ntz")
    out = S.abandoned(df, "user", "ts", "45 seconds", F.col("kind") == "purchase", now)
    assert found(out) == [("a", 0, 10, 2)]


def test_fold_sessions():
    assert stream.fold_sessions([(0, 10, 2)], [(55, 60, 1), (200, 200, 1)], 45) == [(0, 60, 3), (200, 200, 1)]


def run_stream(spark, batches, job, columns):
    """One file per micro-batch, in order; returns the collected rows."""
    source, out, checkpoint = folders(spark, "test", "in", "out", "checkpoint")
    for rows in batches:
        clicks(spark, rows).coalesce(1).write.mode("append").parquet(source)
        df = stream_table(spark, source, "user string, ts timestamp_ntz").withColumn("ts", F.col("ts").cast("timestamp"))
        sinks.sink_append(job(df), out, checkpoint, available_now=True).awaitTermination()
    return spark.read.parquet(out).select(*columns).collect()


# Clicks out of order across batches, within the watermark delay, then a late closer.
BATCHES = [[("a", 0), ("b", 5), ("a", 100)], [("a", 40), ("b", 45), ("a", 70)], [("c", 1000)], [("c", 5000)]]
FLAT = [row for batch in BATCHES for row in batch]


def test_status_stream_equals_batch_sessions(spark):
    job = lambda df: stream.session_status(df, "user", "ts", 45, "200 seconds")
    rows = run_stream(spark, BATCHES, job, ["user", "status", "start", "end", "clicks"])
    offline = sorted((r["user"], seconds(r["start"]), seconds(r["end"]), r["clicks"])
                     for r in rows if r["status"] == "offline")
    closed = [s for s in brute(FLAT, 45) if s[2] + 45 <= 5000 - 200]
    assert offline == closed
    online = [r for r in rows if r["status"] == "online"]
    assert {r["user"] for r in online} == {"a", "b", "c"}
    assert ("a", 0, 100, 4) in {(r["user"], seconds(r["start"]), seconds(r["end"]), r["clicks"]) for r in online}


def test_status_stream_in_another_time_zone(spark):
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", "America/New_York")
    own.conf.set("spark.sql.shuffle.partitions", "4")
    job = lambda df: stream.session_status(df, "user", "ts", 45, "10 seconds").withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})
    rows = run_stream(own, [[("a", 0), ("a", 40)], [("z", 900)]], job, ["user", "status", "start", "end", "clicks"])
    assert [(r["user"], seconds(r["start"]), seconds(r["end"]), r["clicks"])
            for r in rows if r["status"] == "offline"] == [("a", 0, 40, 2)]


def test_native_stream_equals_batch_sessions(spark):
    job = lambda df: stream.sessions_stream(df, "user", "ts", "45 seconds", "200 seconds")
    rows = run_stream(spark, BATCHES, job, ["user", "start", "end", "clicks"])
    got = sorted((r["user"], seconds(r["start"]), seconds(r["end"]), r["clicks"]) for r in rows)
    assert got == [s for s in brute(FLAT, 45) if s[2] + 45 <= 5000 - 200]


def test_late_clicks_are_dropped(spark):
    job = lambda df: stream.session_status(df, "user", "ts", 45, "10 seconds")
    rows = run_stream(spark, [[("a", 0), ("a", 1000)], [("a", 20)], [("z", 9000)]], job, ["user", "status", "start", "clicks"])
    offline = sorted((r["user"], seconds(r["start"]), r["clicks"]) for r in rows if r["status"] == "offline")
    assert offline == [("a", 0, 1), ("a", 1000, 1)]


def test_named_state_equals_batch_sessions(spark):
    """Online rows after each batch, offline rows by timer, and the open spans in between."""
    from tidemark.streaming import session_state as state
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    own.conf.set("spark.sql.shuffle.partitions", "3")
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    source, out, checkpoint = folders(spark, "state", "in", "out", "checkpoint")
    seen, watermark = [], float("-inf")
    for rows in BATCHES:
        clicks(spark, rows).coalesce(1).write.mode("append").parquet(source)
        df = stream_table(own, source, "user string, ts timestamp_ntz").withColumn("ts", F.col("ts").cast("timestamp"))
        sinks.sink_append(state.session_updates(df, "user", "ts", 45, "200 seconds"), out, checkpoint, available_now=True).awaitTermination()
        seen += rows
        watermark = max(s for _, s in seen) - 200
        assert found(state.open_spans(own, checkpoint, "user")) == [s for s in brute(seen, 45) if s[2] + 45 > watermark]
    result = spark.read.parquet(out).collect()
    plain = lambda status: sorted((r["user"], seconds(r["start"]), seconds(r["end"]), r["clicks"]) for r in result if r["status"] == status)
    assert plain("offline") == [s for s in brute(FLAT, 45) if s[2] + 45 <= watermark]
    # First batch; a and b grow in the second; c twice.
    assert plain("online") == [("a", 0, 0, 1), ("a", 0, 100, 4), ("a", 100, 100, 1), ("b", 5, 5, 1), ("b", 5, 45, 2), ("c", 1000, 1000, 1), ("c", 5000, 5000, 1)]
    # The state of an earlier batch can still be read.
    assert found(state.open_spans(own, checkpoint, "user", 0)) == [("a", 0, 0, 1), ("a", 100, 100, 1), ("b", 5, 5, 1)]


def test_a_timer_is_due_at_the_watermark_not_before(spark):
    """A span whose end plus the gap is the watermark is closed; a microsecond more keeps it."""
    from tidemark.streaming import session_state as state
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    own.conf.set("spark.sql.shuffle.partitions", "2")
    job = lambda df: state.session_updates(df, "user", "ts", 45, "100 seconds")
    rows = run_stream(own, [[("a", 55), ("b", 55.000001)], [("z", 200)]], job, ["user", "status"])
    assert sorted(r["user"] for r in rows if r["status"] == "offline") == ["a"]


def test_chained_alerts(spark):
    """Sessions closed per window: the window shows when the watermark passes it."""
    rows = [("a", 0), ("a", 10), ("b", 20), ("c", 130), ("d", 400)]
    job = lambda df: stream.abandoned_rate_stream(df, "user", "ts", "45 seconds", "10 seconds", F.col("user") == "b", "100 seconds")
    out = run_stream(spark, [rows, [("e", 9000)]], job, ["start", "end", "sessions", "abandoned"])
    assert sorted((seconds(r["start"]), r["sessions"], r["abandoned"]) for r in out) == [(0, 2, 1), (100, 1, 1), (400, 1, 1)]


def test_heavy_hitters_stay_small_and_bound_their_error(spark):
    from tidemark.streaming import heavy
    rng = random.Random(4)
    batches = [[f"k{min(int(rng.paretovariate(0.8)), 3000)}" for _ in range(3000)] + [None] * 5 for _ in range(4)]
    source, path, checkpoint = folders(spark, "heavy", "in", "out", "checkpoint")
    frames = [spark.createDataFrame([(k,) for k in batch], "k string") for batch in batches]
    for frame in frames:
        frame.coalesce(1).write.mode("append").parquet(source)
        heavy.heavy_stream(stream_table(spark, source, "k string", max_files=1), "k", path, checkpoint, 50, available_now=True).awaitTermination()
    true = {}
    for n, batch in enumerate(batches):
        for k in batch:
            true[k] = true.get(k, 0) + 1
        rows = heavy.read_summary(spark, path, n).collect()
        error = max(r["error"] for r in rows)
        kept = {r["k"]: r["count"] for r in rows if r["k"] is not None}
        assert len(kept) <= 50 and 0 < error <= 3000 * (n + 1) / 50
        assert all(kept[k] <= true[k] <= kept[k] + error for k in kept)
        assert all(c <= error for k, c in true.items() if k is not None and k not in kept)
    everything = spark.read.schema("k string").parquet(source)
    top = heavy.verified_top(everything, heavy.read_summary(spark, path), "k", 5).collect()
    wanted = sorted(((c, k) for k, c in true.items() if k), key=lambda x: (-x[0], x[1]))[:5]
    assert sorted(((r["count"], r["k"]) for r in top), key=lambda x: (-x[0], x[1])) == wanted
    assert all(r["complete"] == (wanted[-1][0] > error) for r in top)
    # Too small a summary says so: 20 keys are nearly as frequent as the only one kept.
    even = spark.createDataFrame([("a",)] * 5 + [(f"b{n}",) for n in range(20)] * 4, "k string")
    few = heavy.fold(heavy.read_summary(spark, path, 0).limit(0), even.groupBy("k").count(), "k", 3)
    assert [(r["k"], r["count"], r["complete"]) for r in heavy.verified_top(even, few, "k", 3).collect()] == [("a", 5, False)]


def test_top_users_beyond_the_summary_are_counted(spark):
    from tidemark.streaming import heavy
    even = spark.createDataFrame([("a",)] * 5 + [(f"b{n}",) for n in range(20)] * 4 + [(None,)] * 9, "k string")
    none = spark.createDataFrame([], "k string, count long, error long")
    few = heavy.fold(none, even.groupBy("k").count(), "k", 3)
    assert [tuple(r) for r in heavy.exact_top(even, few, "k", 3).collect()] == [("a", 5, True), ("b0", 4, True), ("b1", 4, True)]


def test_users_share_states_and_fold_as_alone(spark):
    """Spans of many users folded at once are those folded user by user; a batch keeps one state per bucket, not per user."""
    import pandas as pd
    from tidemark.streaming import session_state as state
    rng = random.Random(7)
    draw = lambda n: [(rng.randrange(40), s, s + rng.randrange(30), 1 + rng.randrange(3)) for s in (rng.randrange(2000) for _ in range(n))]
    old, new = draw(200), draw(300)
    alone = lambda rows, u: [r[1:] for r in rows if r[0] == u]
    frame = lambda rows: pd.DataFrame(rows, columns=["user", "start_us", "end_us", "clicks"])
    before = stream.merged_spans(None, frame(old), 20).assign(touched=False)
    after = stream.merged_spans(before, frame(new), 20)
    for u in range(40):
        was = stream.fold_sessions([], alone(old, u), 20)
        now = stream.fold_sessions(was, alone(new, u), 20)
        mine = after[after["user"] == u]
        assert list(zip(mine["start_us"], mine["end_us"], mine["clicks"])) == now
        assert mine["touched"].tolist() == [s not in was for s in now]
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    own.conf.set("spark.sql.shuffle.partitions", "3")
    source, out, checkpoint = folders(spark, "shared", "in", "out", "checkpoint")
    clicks(spark, [(f"u{n}", n % 50) for n in range(3000)]).write.parquet(source)
    df = stream_table(own, source, "user string, ts timestamp_ntz").withColumn("ts", F.col("ts").cast("timestamp"))
    sinks.sink_append(state.session_updates(df, "user", "ts", 45, "200 seconds"), out, checkpoint, available_now=True).awaitTermination()
    kept = own.read.format("statestore").option("path", checkpoint).option("stateVarName", state.SPANS).load()
    assert kept.select("key").distinct().count() <= stream.BUCKETS
    assert state.open_spans(own, checkpoint, "user").count() == 3000
