"""Point-in-time features and versioned feature tables."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import history as H
from tidemark.plans.common import folders

T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return None if minutes is None else T0 + dt.timedelta(minutes=minutes)


def run(spark, labels, features, max_age=None, minutes=None):
    """labels: (id, key, minute), features: (key, minute, seq, value)."""
    left = spark.createDataFrame([(i, k, at(m)) for i, k, m in labels], "id long, k string, ts timestamp_ntz")
    right = spark.createDataFrame([(k, at(m), s, v) for k, m, s, v in features], "k string, time timestamp_ntz, seq int, v int")
    found = H.as_of_features(left, H.History(right, ["k"], "time", ["v"], [F.desc("seq")], max_age), "ts", "found")
    return sorted(((r["id"], r["v"], r["found"]) for r in found.collect()), key=str)


def slow(labels, features, minutes=None):
    out = []
    for i, k, m in labels:
        known = [(fm, s, v) for fk, fm, s, v in features if fk is not None and fk == k and m is not None and fm is not None and fm <= m]
        best = max(known, key=lambda f: f[:2], default=None)
        if best and minutes is not None and best[0] < m - minutes:
            best = None
        out.append((i, best and best[2], best and at(best[0])))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    key = lambda: "hot" if rng.random() < 0.6 else rng.choice(["a", "b", "c", None])
    minute = lambda: None if rng.random() < 0.03 else rng.randrange(400)
    labels = [(i % 190, key(), minute()) for i in range(200)]
    features = [(key(), minute(), n, rng.choice([None, n])) for n in range(150)]
    assert run(spark, labels, features) == slow(labels, features)
    assert run(spark, labels, features, "20 minutes") == slow(labels, features, 20)


def test_edges(spark):
    assert run(spark, [], [("a", 1, 1, 1)]) == []
    assert run(spark, [(1, "a", 5), (1, "a", 5)], []) == [(1, None, None)] * 2
    same = [("a", 5, 1, 10), ("a", 5, 2, 20), ("a", 6, 3, 30)]
    assert run(spark, [(1, "a", 5)], same) == [(1, 20, at(5))]
    labels = spark.createDataFrame([(1, "a", T0)], "v long, k string, ts timestamp_ntz")
    with pytest.raises(ValueError, match="columns \\['v'\\]"):
        H.as_of_features(labels, H.History(labels, ["k"], "ts", ["v"], []), "ts")


def test_a_hot_key_is_spread_over_ranges(spark):
    """One key holds 90 % of the times; no range holds more than its share, and the carried rows are few."""
    times = spark.range(20_000).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("_at"),
        (F.col("id") % 3 == 0).alias("_is_feature"), (F.col("id") % 3 != 0).alias("_is_label"))
    own = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranges = H.time_ranges(times, ["k"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", own)
    sizes = [r["count"] for r in ranges.groupBy("_part", "k").count().where("k = 'hot'").collect()]
    assert sum(sizes) == 18_000 and len(sizes) >= 6 and max(sizes) < 5_000
    found = H.newest_times(ranges, ["k"])
    wrong = found.where("k = 'hot'").withColumn("want", F.floor(F.col("_at") / 3) * 3).withColumn(
        "want", F.when(F.col("want") % 10 == 9, F.col("want") - 3).otherwise(F.col("want")))
    assert wrong.count() == 12_000 and wrong.where("want != _found").count() == 0


def test_the_plan_never_orders_whole_keys(spark, capsys):
    """The only window over rows is inside ranges; the one over keys sees one row per key and range."""
    left = spark.createDataFrame([(1, "a", T0)], "id long, k string, ts timestamp_ntz")
    right = spark.createDataFrame([("a", T0, 1)], "k string, time timestamp_ntz, v int")
    H.as_of_features(left, H.History(right, ["k"], "time", ["v"], [F.desc("v")]), "ts").explain("formatted")
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    windows = [w for w in plan.split("\n\n") if "] Window" in w or ") Window\n" in w]
    assert windows and all("_part" in w or "row_number" in w for w in windows)


def test_training_set_of_two_histories(spark):
    labels = spark.createDataFrame([(1, "a", at(10), True), (2, "b", at(10), False)], "id long, k string, ts timestamp_ntz, y boolean")
    one = spark.createDataFrame([("a", at(1), 5), ("a", at(11), 6)], "k string, time timestamp_ntz, f int")
    two = spark.createDataFrame([("a", at(10), 7.0), ("b", at(2), 8.0)], "k string, time timestamp_ntz, g double")
    histories = [H.History(one, ["k"], "time", ["f"], []), H.History(two, ["k"], "time", ["g"], [], "5 minutes")]
    histories = [h._replace(order=[F.desc(h.features[0])]) for h in histories]
    out = H.training_set_as_of(labels, histories, "y", "ts", exclude=["k"])
    assert out.columns == ["id", "ts", "f", "g", "y"]
    assert sorted(tuple(r) for r in out.drop("ts").collect()) == [(1, 5, 7.0, True), (2, None, None, False)]


def test_feature_table_versions(spark):
    path, = folders(spark, "store", "features")
    day = lambda n: F.lit(f"2024-05-{n:02d}").cast("timestamp")
    assert H.read_features(spark, path, ["k"]) is None
    with pytest.raises(ValueError, match="no feature table"):
        H.feature_history(spark, path, ["k"], ["x"])
    assert H.save_features(spark, path, spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, x double"), ["k"], day(1)) == 0
    assert H.save_features(spark, path, spark.createDataFrame([(2, 20.0, "b"), (3, 30.0, "c")], "k int, x double, y string"), ["k"], day(3)) == 1
    assert H.save_features(spark, path, spark.createDataFrame([(2, 20.0, "b"), (4, None, "d")], "k int, x double, y string"), ["k"], day(5), "overwrite") == 2
    read = lambda n: H.read_features(spark, path, ["k"], n and day(n))
    assert read(2).columns == ["k", "x"] and sorted(tuple(r) for r in read(2).collect()) == [(1, 1.0), (2, 2.0)]
    assert sorted(tuple(r) for r in read(4).select("k", "x", "y").collect()) == [(1, 1.0, None), (2, 20.0, "b"), (3, 30.0, "c")]
    assert sorted(tuple(r) for r in read(None).select("k", "x", "y").collect()) == [(2, 20.0, "b"), (4, None, "d")]
    # Rows that stay the same are not written again; a deleted row is a time without features.
    log = H._versions(spark, path, None).where("_commit_version = 2")
    assert sorted((r["k"], r["_change_type"]) for r in log.collect()) == [(1, "delete"), (3, "delete"), (4, "insert")]
    labels = spark.createDataFrame([(n, k, dt.datetime(2024, 5, n)) for n in (2, 4, 6) for k in (1, 2, 3)], "n int, k int, ts timestamp")
    found = H.as_of_features(labels, H.feature_history(spark, path, ["k"], ["x"]), "ts")
    assert sorted(((r["n"], r["k"], r["x"]) for r in found.collect()), key=str) == sorted([
        (2, 1, 1.0), (2, 2, 2.0), (2, 3, None), (4, 1, 1.0), (4, 2, 20.0), (4, 3, 30.0), (6, 1, None), (6, 2, 20.0), (6, 3, None)], key=str)
    with pytest.raises(ValueError, match="unknown mode"):
        H.save_features(spark, path, labels, ["k"], day(7), "upsert")
