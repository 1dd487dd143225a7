import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars
from tidemark.operators import (additive, attribution, elbow, features as FT, forecast as FC, layout, metrics, models, quantiles, runs,
                                sampling, stats, trends)
from tidemark.plans.common import folders
from tidemark.sources.files import write_parquet


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_scalars(spark):
    day = lambda text: F.lit(text).cast("date")
    assert one(spark, scalars.weekday_sun0(day("2024-01-07"))) == 0
    assert one(spark, scalars.weekday_sun0(day("2024-01-06"))) == 6
    assert [one(spark, scalars.is_weekend(day(d))) for d in ("2024-01-05", "2024-01-06", "2024-01-07")] == [0, 1, 1]
    assert str(one(spark, scalars.month_start(day("2024-03-17")))) == "2024-03-01"
    assert one(spark, scalars.clean_quotes(F.lit('"a"b'))) == "ab"
    status = lambda p: one(spark, scalars.threshold_label(F.lit(p).cast("double"), 0.5, "healthy", "damaged"))
    assert [status(0.4), status(0.5), status(None)] == ["healthy", "damaged", None]
    metrics_map = F.create_map(F.lit("auc"), F.lit(0.5))
    assert one(spark, scalars.metric(metrics_map, "auc")) == 0.5 and one(spark, scalars.metric(metrics_map, "x")) is None
    assert one(spark, scalars.cluster_name(F.lit(0), {"cluster_1": "small"})) == "small"
    assert one(spark, scalars.cluster_name(F.lit(9), {"cluster_1": "small"})) is None
    hours = [scalars.cyclic(F.lit(h), 24)[0] for h in (0, 23)]
    assert one(spark, hours[0]) != pytest.approx(one(spark, hours[1]))
    wrapped = [scalars.cyclic(F.lit(h), 23)[0] for h in (0, 23)]
    assert one(spark, wrapped[0]) == pytest.approx(one(spark, wrapped[1]), abs=1e-12)


def test_daily_total_groups_by_day(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, h), 1.0) for h in (1, 2)], "ts timestamp_ntz, v double")
    assert [tuple(r)[1] for r in trends.total_by_day(df, "ts", "v", "power").collect()] == [2.0]


def test_recent(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, s),) for s in (0, 30)], "ts timestamp_ntz")
    assert trends.recent(df, "ts", 60, F.lit("2024-01-01 00:01:00").cast("timestamp_ntz")).count() == 1


def test_key_split_is_stable_complete_and_disjoint(spark):
    df = spark.range(2000)
    parts = sampling.split_keys(df, ["id"], [0.9, 0.1], 1)
    ids = [{r["id"] for r in p.collect()} for p in parts]
    again = [{r["id"] for r in p.collect()} for p in sampling.split_keys(df.repartition(13), ["id"], [9, 1], 1)]
    assert ids == again and not ids[0] & ids[1] and len(ids[0] | ids[1]) == 2000
    assert 120 < len(ids[1]) < 280
    assert 0 < sampling.sample_rows(df, 0.1, 1).count() < 2000 and len(sampling.split_rows(df, [1, 1], 1)) == 2


def test_class_weights_and_null_columns(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 3)], "label string, v int")
    assert sorted((r["label"], r["weight"]) for r in stats.class_weights(df, "label").collect()) == [
        ("a", 0.5), ("a", 0.5), ("b", 1.0)]
    assert stats.drop_null_columns(df).columns == ["label"]


def test_minmax_of_a_constant(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 3.0)], "a double, b double")
    assert [tuple(r) for r in stats.minmax(df, ["a", "b"]).collect()] == [(0.0, 0.0), (0.0, 10.0)]


def brute_auc(rows):
    pos, neg = [s for y, s in rows if y == 1], [s for y, s in rows if y == 0]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("distinct", [2, 50, 100000])
def test_auc_equals_pair_count(spark, distinct):
    rng = random.Random(distinct)
    rows = [(rng.randrange(2), rng.randrange(distinct) / distinct) for _ in range(1500)]
    df = spark.createDataFrame(rows, "y int, s double")
    assert metrics.auc(df, "y", "s").first()["auc"] == pytest.approx(brute_auc(rows), abs=1e-12)


def test_auc_with_one_class_is_null(spark):
    assert metrics.auc(spark.createDataFrame([(1, 0.5)], "y int, s double"), "y", "s").first()["auc"] is None


def test_lookups_refuse_duplicate_keys(spark):
    labels = spark.createDataFrame([(1, True)], "k int, y boolean")
    twice = spark.createDataFrame([(1, 1.0), (1, 2.0)], "k int, f double")
    with pytest.raises(Exception, match="several rows"):
        FT.build_training_set(labels, [FT.lookups_for(twice, "k")], "y").collect()


def test_training_set_excludes_the_key(spark):
    labels = spark.createDataFrame([(1, True), (2, False)], "k int, y boolean")
    table = spark.createDataFrame([(1, 1.0)], "k int, f double")
    out = FT.build_training_set(labels, [FT.lookups_for(table, "k")], "y", exclude=["k"])
    assert sorted((tuple(r) for r in out.collect()), key=str) == [(1.0, True), (None, False)]


def test_salted_enrich_spreads_a_hot_key(spark):
    df = spark.range(1000).selectExpr("id", "CASE WHEN id < 900 THEN 1 ELSE id END AS k")
    static = spark.createDataFrame([(1, "hot"), (950, "x")], "k long, s string")
    plain, salted = FT.enrich(df, static, ["k"]), FT.enrich(df, static, ["k"], salts=8)
    assert sorted(map(str, plain.collect())) == sorted(map(str, salted.select(plain.columns).collect()))


def test_write_features_modes(spark):
    old = spark.createDataFrame([(1, "a")], "k int, x string")
    new = spark.createDataFrame([(1, 10), (2, 20)], "k int, y int")
    merged = FT.write_features(old, new, ["k"])
    assert sorted(tuple(r) for r in merged.select("k", "x", "y").collect()) == [(1, "a", 10), (2, None, 20)]
    assert FT.write_features(old, new, ["k"], "overwrite").columns == ["k", "y"]


# ---------------------------------------------------------------- layout

def test_range_numbers_equal_counting(spark):
    cuts = [3, 7, 7.5, 20]
    got = spark.range(30).select("id", layout.range_number(F.col("id"), cuts).alias("n")).collect()
    assert all(r["n"] == sum(c < r["id"] for c in cuts) for r in got)


def test_zorder_narrows_both_columns_and_keeps_all_rows(spark):
    rng = random.Random(1)
    data = [(rng.choice("ABCDEFGH") + "x" * rng.randrange(3), rng.randrange(1000)) for _ in range(4000)]
    df = spark.createDataFrame(data, "s string, n int")
    out = layout.zorder(df, ["s", "n"], files=16)
    assert sorted(map(tuple, out.collect())) == sorted(data)
    spread = out.groupBy(F.spark_partition_id()).agg((F.max("n") - F.min("n")).alias("n"), F.countDistinct("s").alias("s"))
    mean = spread.agg(F.avg("n").alias("n"), F.avg("s").alias("s")).first()
    assert mean["n"] < 600 and mean["s"] < 0.6 * len({s for s, _ in data})


def test_zorder_splits_a_value_that_most_rows_share(spark):
    df = spark.range(4000).selectExpr("id", "CASE WHEN id < 3000 THEN 'NY' ELSE cast(id as string) END AS s")
    sizes = layout.zorder(df, ["s"], files=8).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 1500


def test_compaction_reduces_files(spark):
    small, large = folders(spark, "compact", "small", "large")
    write_parquet(spark.range(1000).repartition(40), small)
    layout.write_compacted(spark.read.parquet(small), large)
    detail = lambda path: layout.table_detail(spark.read.parquet(path)).first()
    assert detail(small)["n_files"] == 40 and detail(large)["n_files"] < 5
    assert detail(large)["n_rows"] == 1000 and detail(large)["n_bytes"] > 0


# ---------------------------------------------------------------- forecasts

def season(n=1200, noise=0.0):
    rng = np.random.default_rng(0)
    t = np.arange(n)
    y = (100 + 0.05 * t) * (1 + 0.2 * np.sin(2 * np.pi * t / 7) + 0.1 * np.cos(2 * np.pi * t / 365.25))
    return t.astype(float), y + noise * rng.standard_normal(n)


def test_additive_model_recovers_the_signal():
    t, y = season()
    at = np.arange(1200, 1230).astype(float)
    wanted = (100 + 0.05 * at) * (1 + 0.2 * np.sin(2 * np.pi * at / 7) + 0.1 * np.cos(2 * np.pi * at / 365.25))
    out = additive.fit_predict(t, y, at, FC.Params())
    assert np.abs(out["yhat"] - wanted).max() < 3
    assert sorted(out) == sorted(FC.FORECAST_COLUMNS)
    assert np.allclose(out["multiplicative_terms"], out["weekly"] + out["yearly"])
    assert np.allclose(out["yhat"], out["trend"] * (1 + out["multiplicative_terms"]))


def test_interval_covers_about_its_width():
    t, y = season(noise=5.0)
    out = additive.fit_predict(t, y, t, FC.Params(interval_width=0.8))
    assert 0.72 < ((y >= out["yhat_lower"]) & (y <= out["yhat_upper"])).mean() < 0.88


def sales(spark, n=1100, stores=2):
    t, y = season(n, 2.0)
    start = dt.date(2015, 1, 1)
    return spark.createDataFrame([(s, start + dt.timedelta(days=int(d)), float(v * (s + 1)) / 2)
                                  for s in range(stores) for d, v in zip(t, y) for _ in range(2)],
                                 "store int, day date, sales double")


def test_forecast_by_key_history_and_horizon(spark):
    out = FC.forecast_by_key(sales(spark), ["store"], "day", "sales", 30)
    assert out.columns == ["store", "ds", *FC.FORECAST_COLUMNS]
    counts = out.groupBy("store").agg(F.count("*").alias("n"), F.max("ds").alias("last")).collect()
    assert [(r["n"], str(r["last"])) for r in counts] == [(1130, "2018-02-03")] * 2


def slow_fit(days, y, at, params):
    """Trend and prediction of one model, and the deviations of its fit, one regression after the other."""
    start, span = days.min(), max(1, days.max() - days.min())
    basis = lambda d: np.column_stack([np.ones(len(d)), (d - start) / span])
    floor = max(1e-9, 0.01 * float(np.abs(y).mean()))
    waves = lambda d: np.hstack([np.zeros((len(d), 0)), *(additive.fourier(d, t) for t in params.terms)])
    design, season = waves(days), np.zeros(len(days))
    gamma = np.zeros(design.shape[1])
    for _ in range(additive.TURNS):
        beta = np.linalg.lstsq(basis(days), y / np.maximum(1 + season, 0.05), rcond=None)[0]
        line = np.maximum(basis(days) @ beta, floor)
        gamma = np.linalg.solve(design.T @ design + params.ridge * np.eye(len(gamma)), design.T @ (y / line - 1))
        season = design @ gamma
    trend = np.maximum(basis(at) @ beta, floor)
    leverage = np.einsum("ij,jk,ik->i", basis(at), np.linalg.pinv(basis(days).T @ basis(days)), basis(at))
    return trend, trend * (1 + waves(at) @ gamma), np.std(y - line * (1 + season)), np.std(y - line) * np.sqrt(np.maximum(leverage, 0))


@pytest.mark.parametrize("weekly,yearly", [(True, True), (True, False), (False, True), (False, False)])
def test_batched_models_equal_single_ones(weekly, yearly):
    rng = np.random.default_rng(9)
    for n in (1, 2, 5, 40, 900):
        days = np.sort(rng.choice(1500, n, replace=False)) + 17_000
        y = rng.gamma(2.0, 20.0, n)
        at = np.concatenate([days, days[-1] + np.arange(1, 6)])
        params = FC.Params(weekly, yearly, ridge=0.5, interval_width=0.9)
        trend, yhat, error, noise = slow_fit(days, y, at, params)
        out = additive.fit_predict(days, y, at, params)
        assert np.allclose(out["trend"], trend) and np.allclose(out["yhat"], yhat)
        assert np.allclose(out["yhat_upper"] - yhat, params.z * error, atol=1e-7)
        assert np.allclose(trend - out["trend_lower"], params.z * noise, atol=1e-7)


def test_batched_search_equals_single_fits():
    t, y = season(1000, 4.0)
    keep = np.sort(np.random.default_rng(2).choice(1000, 600, replace=False))
    days, y = t[keep].astype(int), y[keep]
    candidates = FC.search_space(6)
    for params, (n, rmse, coverage) in zip(candidates, additive.rolling_errors(days, y, candidates, 300, 90, 120)):
        errors, inside = [], []
        for cut in range(days[-1] - 120, days[0] + 300 - 1, -90):
            past, ahead = days <= cut, (days > cut) & (days <= cut + 120)
            _, yhat, spread, _ = slow_fit(days[past], y[past], days[ahead], params)
            errors.append(y[ahead] - yhat)
            inside.append(np.abs(y[ahead] - yhat) <= params.z * spread)
        error = np.concatenate(errors)
        assert n == len(error) and rmse == pytest.approx(np.sqrt((error ** 2).mean()))
        assert coverage == pytest.approx(np.concatenate(inside).mean())


def test_series_across_arrow_batches(spark):
    rows = [(s, f"i{s % 7}", dt.date(2020, 1, 1) + dt.timedelta(days=d), float(d + s)) for s in range(40) for d in range(0, 60, 1 + s % 5)]
    df = spark.createDataFrame(rows, "store int, item string, day date, sales double")
    keys = ["store", "item"]
    read = lambda: sorted(map(tuple, FC.forecast_by_key(df, keys, "day", "sales", 3).select(*keys, "ds", F.round("yhat", 3)).collect()))
    whole = read()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert read() == whole and len(whole) == sum(len(range(0, 60, 1 + s % 5)) + 3 for s in range(40))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_rolling_cv_does_not_repeat_days_per_cut_off(spark, capsys):
    out = FC.rolling_cv(FC.daily_series(sales(spark), ["store"], "day", "sales"), ["store"])
    out.explain()
    plan = capsys.readouterr().out
    assert "Join" not in plan and "Generate" not in plan and plan.count("MapInArrow") == 1


def test_cut_off_after_a_single_day(spark):
    """One day of history has no line: its predictions are NULL."""
    days = [dt.date(2015, 1, 1), dt.date(2018, 1, 1), dt.date(2018, 3, 1)]
    df = spark.createDataFrame([(1, d, 2.0) for d in days] + [(2, days[0], 1.0)], "store int, ds date, y double")
    rows = FC.rolling_cv(df, ["store"], horizon=60).collect()
    assert [(str(r["cutoff"]), str(r["ds"]), r["yhat"], r["yhat_upper"]) for r in rows] == [("2017-12-31", "2018-01-01", None, None), ("2017-12-31", "2018-03-01", None, None)]


def test_a_series_of_one_day(spark):
    df = spark.createDataFrame([(1, dt.date(2020, 1, 1), 5.0)], "store int, day date, sales double")
    out = FC.forecast_by_key(df, ["store"], "day", "sales", 2).collect()
    assert len(out) == 3 and all(abs(r["yhat"] - 5) < 1 for r in out)


def test_search_prefers_the_right_seasonality(spark):
    candidates = [FC.Params(weekly=False, yearly=False), FC.Params(weekly=True, yearly=True)]
    found = FC.forecast_search(sales(spark), ["store"], "day", "sales", candidates)
    best = FC.best_candidate(found, ["store"]).collect()
    assert [r["candidate"] for r in best] == [1, 1] and all(r["n"] > 0 for r in best)
    assert FC.search_space(12) == FC.search_space(12) and len(FC.search_space(12)) == 12


def test_metrics_with_coverage(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1), dt.date(2020, 1, 2), 1.0, 2.0, 0.0, 3.0),
                                (dt.date(2020, 1, 1), dt.date(2020, 1, 2), 4.0, 2.0, 0.0, 3.0)],
                               "cutoff date, ds date, y double, yhat double, yhat_lower double, yhat_upper double")
    row = FC.forecast_metrics(df).first()
    assert (row["horizon"], row["mse"], row["mae"], row["coverage"]) == (1, 2.5, 1.5, 0.5)


# ---------------------------------------------------------------- models

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def fitted(spark):
    rng = np.random.default_rng(3)
    x = rng.uniform(-1, 1, (800, 3))
    status = np.where((x[:, 0] > 0.2) & (x[:, 1] > -0.5), "damaged", "healthy")
    df = spark.createDataFrame(pd.DataFrame(x, columns=FEATURES).assign(id=range(800), status=status)).repartition(4)
    weighted = stats.class_weights(df, "status")
    model = models.train(models.damage_classifier(FEATURES, "status", depths=(3,), iterations=4, weight="weight"),
                         weighted, [*FEATURES, "status", "weight"])
    return df, model


def test_classifier_scores_saves_and_loads(spark, fitted):
    df, model = fitted
    assert metrics.label_metrics(model.transform(df), float(models.label_index(model, "damaged"))).first()["f1"] > 0.95
    path, out = folders(spark, "model", "model", "scored")
    models.save_model(model, path)
    models.score_and_write(models.load_model(path), df.drop("status"), ["id"], out)
    saved = spark.read.parquet(out)
    assert saved.count() == 800 and {r["status"] for r in saved.select("status").distinct().collect()} == {"healthy", "damaged"}
    lookup = FT.Lookup(df, "id", FEATURES)
    assert models.score_batch(model, df.select("id"), [lookup], ["id"], "damaged").count() == 800


def test_importance(spark, fitted):
    top = models.feature_importance(fitted[1], FEATURES).collect()
    assert {top[0]["feature"], top[1]["feature"]} == {"a", "b"} and sum(r["weight"] for r in top) == pytest.approx(1)


@pytest.mark.parametrize("cut", [-0.6, 0.6])
def test_status_follows_the_label_not_its_frequency(spark, cut):
    rng = np.random.default_rng(8)
    x = rng.uniform(-1, 1, (600, 3))
    status = np.where(x[:, 0] > cut, "damaged", "healthy")
    df = spark.createDataFrame(pd.DataFrame(x, columns=FEATURES).assign(id=range(600), status=status))
    model = models.train(models.damage_classifier(FEATURES, "status", depths=(2,), iterations=2), df, [*FEATURES, "status"])
    scored = models.with_status(models.score_table(model, df, ["id"], "damaged"))
    assert sum(r["status"] == status[r["id"]] for r in scored.collect()) > 590


def brute_shapley(trees, x):
    """Average over all feature orders of the change in the tree's mean when a feature becomes known."""
    from itertools import permutations

    def mean(nodes, at, known):
        node = nodes[at]
        if node["leftChild"] < 0:
            return node["prediction"]
        left, right, feature = node["leftChild"], node["rightChild"], node["split"]["featureIndex"]
        if feature in known:
            return mean(nodes, left if x[feature] <= node["split"]["leftCategoriesOrThreshold"][0] else right, known)
        share = nodes[left]["rawCount"] / node["rawCount"]
        return share * mean(nodes, left, known) + (1 - share) * mean(nodes, right, known)

    phi, orders = np.zeros(len(x)), list(permutations(range(len(x))))
    for weight, nodes in trees:
        for order in orders:
            for n, j in enumerate(order):
                phi[j] += weight * (mean(nodes, 0, order[: n + 1]) - mean(nodes, 0, order[:n]))
    return phi / len(orders)


def test_shapley_equals_brute_force_and_adds_up(spark, fitted):
    from pyspark.ml.functions import vector_to_array
    df, model = fitted
    best = models.best_trees(model)
    ready = model.transform(df).withColumn("margin", vector_to_array("rawPrediction")[1])
    out = attribution.shapley(ready, best, FEATURES, keep=["id", "margin"]).orderBy("id").collect()
    assert all(abs(sum(r[f"{f}_shap"] for f in FEATURES) + r["base"] - r["margin"]) < 1e-9 for r in out)
    path, = folders(spark, "trees", "model")
    best.write().save(path)
    trees: dict = {}
    for row in spark.read.parquet(f"{path}/data").collect():
        trees.setdefault(row["treeID"], {})[row["nodeData"]["id"]] = row["nodeData"]
    vectors = {r["id"]: np.array(r["v"]) for r in ready.select("id", vector_to_array("features").alias("v")).collect()}
    for r in out[:10]:
        wanted = brute_shapley([(best.treeWeights[n], trees[n]) for n in trees], vectors[r["id"]])
        assert np.allclose([r[f"{f}_shap"] for f in FEATURES], wanted)


def test_the_search_runs_over_cells_and_counts_rows(spark, monkeypatch):
    from pyspark.ml.tuning import CrossValidator
    seen, fit = [], CrossValidator.fit
    monkeypatch.setattr(CrossValidator, "fit", lambda self, data: (seen.append(data.count()), fit(self, data))[1])
    rng = np.random.default_rng(5)
    x = rng.integers(0, 5, (4000, 2))
    df = spark.createDataFrame(pd.DataFrame(x, columns=["u", "v"]).assign(status=np.where((x[:, 0] > 2) & (x[:, 1] < 2), "damaged", "healthy")))
    weighted = stats.class_weights(df, "status")
    model = models.train(models.damage_classifier(["u", "v"], "status", depths=(2, 3), weight="weight"), weighted, ["u", "v", "status", "weight"])
    assert seen and max(seen) <= 5 * 5 * 2  # cells of two folds, not 4,000 rows
    assert metrics.label_metrics(model.transform(df), float(models.label_index(model, "damaged"))).first()["f1"] == 1
    path, = folders(spark, "trees", "model")
    models.best_trees(model).write().save(path)
    for r in spark.read.parquet(f"{path}/data").collect():
        node = r["nodeData"]
        if node["id"] == 0:
            assert node["rawCount"] == 4000


def test_cuts_are_those_of_all_rows(spark, monkeypatch):
    assert models.tree_cuts([(v, v, 1.0) for v in (1.0, 2.0, 4.0)], 32) == [1.5, 3.0]
    held = [(float(v), float(v), 1.0) for v in range(100)]
    cuts = models.tree_cuts(held, 4)
    assert cuts == [24.5, 49.5, 74.5]
    df = spark.range(40000).selectExpr("cast(id as double) AS u", "id % 3 AS v", "1D AS w")
    monkeypatch.setattr(models, "GRID", 256)
    u, v = models.tree_bins(df, ["u", "v"], F.col("w")).getSplitsArray()
    assert len(u) == 33 and np.allclose(u[1:-1], np.arange(1, 32) * 1250, atol=40000 / 256)
    assert np.allclose(v[1:-1], [0.5, 1.5])


def test_values_by_cell_equal_values_by_leaf():
    rng = np.random.default_rng(2)
    leaves = []
    for _ in range(30):
        used = np.sort(rng.choice(4, rng.integers(1, 4), replace=False))
        low = rng.integers(-3, 3, len(used)).astype(float)
        high = np.where(rng.random(len(used)) < 0.3, np.inf, low + rng.integers(1, 3, len(used)))
        leaves.append(attribution.Leaf(rng.normal(), used, np.where(rng.random(len(used)) < 0.3, -np.inf, low), high, rng.random(len(used))))
    tables, _ = attribution.prepare(leaves)
    x = rng.integers(-4, 6, (500, 4)).astype(float)  # many of them are cut points
    wanted = attribution.explain(x, tables)
    for limit in (1 << 16, 200, 2):
        assert np.allclose(attribution.explain_cells(x, attribution.cell_tables(tables, 4, limit)), wanted)


def test_clusters_udf_equals_model_and_elbow_falls(spark):
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(m, 0.1, (50, 2)) for m in ((0, 0), (0, 5), (5, 0), (5, 5))])
    df = spark.createDataFrame(pd.DataFrame(x, columns=["u", "v"]))
    names = {f"cluster_{i}": f"s{i}" for i in range(1, 5)}
    model = models.segment_model(df, ["u", "v"], 4)
    both = models.segment(df, model, names).withColumn("again", models.segment_udf(model, names)("u", "v"))
    assert both.filter("segment != again").count() == 0 and both.select("segment").distinct().count() == 4
    costs = {r["k"]: r["cost"] for r in elbow.kmeans_elbow(df, ["u", "v"], range(2, 6)).collect()}
    assert costs[2] > costs[4] and sorted(costs) == [2, 3, 4, 5]


def test_random_search_reports_trials(spark, fitted):
    _, found = models.random_search(fitted[0], FEATURES, "status", trials=2, iterations=2, depth=(2, 3))
    assert found.count() == 2 and all(0.5 <= r["auc"] <= 1 for r in found.collect())


def test_runs(spark):
    df = spark.createDataFrame([("e", "1", "FINISHED", "u1", {"F1": 0.5, "auc": 0.9}), ("e", "2", "FAILED", "u2", {"F1": 0.9}),
                                ("e", "3", "FINISHED", "u3", {"auc": 0.7}), ("e", "4", "FINISHED", "u4", {"F1": 0.6})],
                               "experiment_id string, run_id string, status string, artifact_uri string, metrics map<string,double>")
    assert [r["run_id"] for r in runs.leaderboard(df).collect()] == ["4", "1", "3"]
    assert runs.best_run(df).first()["run_id"] == "4"


def test_many_clusterings_in_one_scan(spark, capsys):
    """Sums, counts and costs of a step equal brute force; the plan reads the rows once for all models."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(700, 3)) * 2
    rows = spark.createDataFrame([(v.tolist(),) for v in x], "x array<double>").repartition(5)
    centres = {k: rng.normal(size=(k, 3)) for k in (1, 3, 6)}
    for k, (sums, counts, cost) in elbow.step(rows, centres).items():
        distance = ((x[:, None, :] - centres[k][None]) ** 2).sum(axis=2)
        near = distance.argmin(axis=1)
        assert np.allclose(sums, [x[near == c].sum(axis=0) for c in range(k)])
        assert counts.tolist() == [(near == c).sum() for c in range(k)] and cost == pytest.approx(distance.min(axis=1).sum())


def test_elbow_finds_the_groups_and_survives_edges(spark):
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(m, 0.05, (80, 2)) for m in ((0, 0), (0, 9), (9, 0), (9, 9), (5, 5))])
    df = spark.createDataFrame(pd.DataFrame(x, columns=["u", "v"])).withColumn("u", F.col("u").cast("float"))
    found = elbow.kmeans_models(df.unionByName(spark.createDataFrame([(None, 1.0)], "u float, v double")), ["u", "v"], range(1, 8))
    costs = [found[k][1] for k in range(1, 8)]
    assert all(a > b for a, b in zip(costs, costs[1:])) and costs[4] < 0.01 * costs[3] and found[5][2] == 400
    same = spark.createDataFrame([(1.0, 1.0)] * 5, "u double, v double")
    assert [r["cost"] for r in elbow.kmeans_elbow(same, ["u", "v"], (1, 3)).collect()] == [0.0, 0.0]
    assert elbow.kmeans_elbow(same.limit(0), ["u", "v"]).collect() == []


def brute_quantile(values, p):
    values = sorted(v for v in values if v is not None and math.isfinite(v))
    return values[max(1, math.ceil(p * len(values))) - 1] if values else None


@pytest.mark.parametrize("bins", [2, 7, 4096])
def test_exact_quantiles_equal_sorting(spark, bins):
    rng = random.Random(bins)
    columns = {"wide": [rng.uniform(-1e300, 1e300) for _ in range(300)], "hot": [1.0 if rng.random() < 0.8 else rng.gauss(0, 1e-9) for _ in range(300)],
               "few": [float(rng.randrange(3)) for _ in range(300)], "one": [5.0] * 300, "none": [None] * 300,
               "odd": [rng.choice([None, float("nan"), float("inf"), -2.5, 1e-320]) for _ in range(300)]}
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns))
    for r in quantiles.exact_quantiles(df, list(columns), [0.0, 0.25, 0.5, 0.9, 1.0], bins).collect():
        assert r["value"] == brute_quantile(columns[r["column"]], r["probability"])


def test_exact_quantiles_beyond_a_million_values(spark):
    df = spark.range(3_000_000).select((F.col("id") * 7919 % 3_000_000).alias("v"))
    assert [r["value"] for r in quantiles.exact_quantiles(df, ["v"], [0.25, 0.5, 0.75]).collect()] == [749_999, 1_499_999, 2_249_999]


def test_random_search_folds_equal_rows_and_keeps_their_weight(spark):
    """Rows of few values: the search sees all of them, and the search over three copies judges alike."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, 8, (900, 2)).astype(float)
    status = np.where((x[:, 0] > 4) ^ (rng.random(900) < 0.1), "damaged", "healthy")
    df = spark.createDataFrame(pd.DataFrame(x, columns=["u", "v"]).assign(status=status))
    assert all(len(s) == 9 for s in models.binner(df, ["u", "v"]).getSplitsArray())
    model, found = models.random_search(df, ["u", "v"], "status", trials=2, iterations=3, depth=(2, 3))
    best = models.best_trees(model)
    assert sum(t.numNodes > 1 for t in best.trees) and all(r["auc"] > 0.7 for r in found.collect())
    path, = folders(spark, "search", "model")
    best.write().save(path)
    top = spark.read.parquet(f"{path}/data").where("treeID = 0 and nodeData.id = 0").select("nodeData.*").first()
    assert top["impurityStats"][0] == 900 and top["rawCount"] < 450  # all rows, in fewer weighted ones
    assert models.score_table(model, df, ["u"], "damaged").where("(u > 4) = (probability > 0.5)").count() == 900


def test_forecasts_of_many_series_are_solved_together(monkeypatch):
    rng = np.random.default_rng(5)
    parts = [8000 + np.sort(rng.choice(1500, n, replace=False)) for n in [1, 2, 700, *rng.integers(3, 40, 300).tolist()]]
    days, bounds = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    y = rng.uniform(1, 50, len(days))
    calls = []
    inv = np.linalg.inv
    monkeypatch.setattr(np.linalg, "inv", lambda a: calls.append(len(a)) or inv(a))
    for params in (FC.Params(), FC.Params(weekly=False, yearly=False), FC.Params(yearly=False, ridge=2.0)):
        found = list(additive.fit_predict_many(days, y, bounds, 7, params))
        seen = set()
        for first, out in found:
            for a in set(first.tolist()):
                b = bounds[np.searchsorted(bounds, a) + 1]
                at = np.concatenate([days[a:b], days[b - 1] + np.arange(1, 8)])
                one, here = additive.fit_predict(days[a:b], y[a:b], at, params), first == a
                assert out["ds"][here].tolist() == at.tolist()
                assert all(np.allclose(out[c][here], one[c], rtol=1e-9, atol=1e-9) for c in one)
                seen.add(a)
        assert len(seen) == len(parts)
    assert sum(calls) == 2 * len(parts) and len(calls) < 20


def test_search_fits_equal_candidates_once(monkeypatch):
    t, y = season(900, 4.0)
    calls, line = [], additive.Fits.line
    monkeypatch.setattr(additive.Fits, "line", lambda self, s: calls.append(1) or line(self, s))
    plain = [FC.Params(weekly=False, yearly=False, ridge=r, interval_width=w) for r, w in ((0.1, 0.5), (2.0, 0.9), (7.0, 0.95))]
    found = additive.rolling_errors(t.astype(int), y, plain, 300, 90, 120)
    assert len(calls) == 1 and len({f[:2] for f in found}) == 1 and found[0][2] < found[1][2] < found[2][2]
