"""Profiling, features, clusters, classification, evaluation and run choice."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import attribution, elbow, features as FT, history as HT, metrics, models, quantiles, runs, sampling, stats
from tidemark.operators.latest import dedupe
from tidemark.plans.common import folders, table
from tidemark.sources import files

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
DIMS = 64
VECTOR = [f"e{i}" for i in range(DIMS)]
SENSORS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]

# The segment names of the clusters.
SEGMENTS = {"cluster_1": "small_spenders", "cluster_2": "medium_spenders",
            "cluster_3": "large_spenders", "cluster_4": "critical_spenders"}


def class_balance(spark, sf_dir):
    return stats.class_balance(table(spark, sf_dir, "lineitem"), "l_returnflag")


def summary_stats(spark, sf_dir):
    out = stats.summary_stats(table(spark, sf_dir, "lineitem"), MEASURES)
    return out.select("column", "count", F.round("mean", 4).alias("mean"), F.round("stddev", 4).alias("stddev"),
                      "min", "p25", "p50", "p75", "max")


def exact_quartiles(spark, sf_dir):
    """Quartiles of the prices, and of a column in which nearly every row has a value of its own."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_extendedprice", (F.col("l_extendedprice") + F.col("l_orderkey") / 1048576 + F.col("l_linenumber") / 8).alias("own"))
    return quantiles.exact_quantiles(lines, lines.columns, [0.25, 0.5, 0.75])


def missing_counts(spark, sf_dir):
    """Left join with labels leaves gaps to count."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return stats.missing_counts(docs.join(table(spark, sf_dir, "labels"), "doc_id", "left"))


def drop_null_columns(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return stats.drop_null_columns(docs.join(table(spark, sf_dir, "labels"), "doc_id", "left"))


def corr_matrix(spark, sf_dir):
    out = stats.correlation_matrix(table(spark, sf_dir, "lineitem"), MEASURES)
    return out.withColumn("r", F.round("r", 6))


def class_weights(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return stats.class_weights(labels, "toxic").withColumn("weight", F.round("weight", 9))


def deduplicated(spark, sf_dir):
    """One line per order: the first by line number, then by the other columns."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    order = [F.asc(c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")]
    return dedupe(lines, ["l_orderkey"], order)


def minmax_scaled(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_acctbal").alias("balance"), F.col("c_nationkey").cast("double").alias("nation"))
    out = stats.minmax(customers, ["balance", "nation"])
    return out.select("c_custkey", *[F.round(c, 6).alias(c) for c in ("balance", "nation")])


def cluster_profile(spark, sf_dir):
    """Mean embedding per label, in long form."""
    wide = table(spark, sf_dir, "embeddings").select(
        "label", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(VECTOR)])
    means = stats.cluster_profile(wide, "label", VECTOR)
    return means.select("label", F.posexplode(F.array(*[F.round(c, 5) for c in VECTOR])).alias("dim", "mean"))


def _vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(VECTOR)])


def kmeans_elbow(spark, sf_dir):
    return elbow.kmeans_elbow(_vectors(spark, sf_dir), VECTOR)


def kmeans_costs(spark, sf_dir):
    """For each k the rows clustered and whether the cost fell; the cost itself for one cluster, which SQL can compute."""
    found = elbow.kmeans_elbow(_vectors(spark, sf_dir), VECTOR, range(1, 10))
    before = found.select((F.col("k") + 1).alias("k"), F.col("cost").alias("before"))
    return found.join(before, "k", "left").select("k", "n", F.when(F.col("k") == 1, F.round("cost", 3)).alias("cost"),
                                                  (F.col("cost") < F.col("before")).alias("falls"))


def segments(spark, sf_dir):
    vectors = _vectors(spark, sf_dir)
    found = models.segment(vectors, models.segment_model(vectors, VECTOR), SEGMENTS)
    return found.select("vec_id", "cluster", "segment")


def segments_udf(spark, sf_dir):
    """The same assignment through a registered SQL function."""
    vectors = _vectors(spark, sf_dir)
    own = spark.newSession()
    own.udf.register("segment_of", models.segment_udf(models.segment_model(vectors, VECTOR), SEGMENTS))
    _vectors(own, sf_dir).createOrReplaceTempView("vectors")
    return own.sql(f"SELECT vec_id, segment_of({', '.join(VECTOR)}) AS segment FROM vectors")


def segments_agree(spark, sf_dir):
    """Of every row: whether its cluster's centre is the nearest one, and whether the SQL function names the same segment."""
    vectors = _vectors(spark, sf_dir)
    model = models.segment_model(vectors, VECTOR)
    scaled = PipelineModel(model.stages[:2]).transform(vectors).select("vec_id", vector_to_array("features").alias("x"))
    distance = [F.aggregate(F.zip_with("x", F.array(*[F.lit(float(v)) for v in centre]), lambda a, b: (a - b) * (a - b)),
                            F.lit(0.0), lambda a, b: a + b) for centre in model.stages[2].clusterCenters()]
    found = models.segment(vectors, model, SEGMENTS).withColumn("again", models.segment_udf(model, SEGMENTS)(*VECTOR))
    near = F.element_at(F.array(*distance), F.col("cluster") + 1) <= F.least(*distance) * (1 + 1e-9)
    return found.select("vec_id", "cluster", "segment", "again").join(scaled, "vec_id").select(
        "vec_id", near.alias("is_nearest"), (F.col("segment") == F.col("again")).alias("is_same"))


def time_features(spark, sf_dir):
    out = FT.time_features(table(spark, sf_dir, "events"), "event_id", "ts", weekend=True)
    return out.select("event_id", *[F.round(c, 6).alias(c) for c in ("cos_month", "sin_month", "cos_hour", "sin_hour")],
                      "is_weekend")


def _feature_tables(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    sensors = FT.sensor_features(events.withColumn("k", F.from_json("props", "k int")["k"]), "event_id", ["value", "k"])
    seasons = FT.time_features(events.filter("event_type != 'view'"), "event_id", "ts")
    labels = FT.damage_label(events, "event_id", "event_type", bad="error")
    return labels, sensors, seasons.select("event_id", *[F.round(c, 6).alias(c) for c in seasons.columns[1:]])


def training_set(spark, sf_dir):
    """Labels with sensor and season features; views have no season row."""
    labels, sensors, seasons = _feature_tables(spark, sf_dir)
    return FT.build_training_set(labels, [FT.lookups_for(sensors, "event_id"), FT.lookups_for(seasons, "event_id")],
                                 "damaged")


def merge_features(spark, sf_dir):
    """Version 1 covers all but views; version 2 adds a column and the missing rows, without clicks."""
    events = table(spark, sf_dir, "events")
    old = FT.time_features(events.filter("event_type != 'view'"), "event_id", "ts").select("event_id", "cos_hour")
    new = FT.time_features(events.filter("event_type != 'click'"), "event_id", "ts", weekend=True)
    merged = FT.write_features(old, new.select("event_id", "is_weekend", (F.col("cos_hour") * 2).alias("cos_hour")),
                               ["event_id"])
    return merged.withColumn("cos_hour", F.round("cos_hour", 6))


def _readings(spark, sf_dir, kind):
    """The events of a kind as a feature history of their users."""
    events = table(spark, sf_dir, "events").filter(F.col("event_type") == kind)
    return events.withColumn("k", F.from_json("props", "k int")["k"])


def training_set_as_of(spark, sf_dir):
    """Purchases with their user's newest view, and newest click of the last three days, as of each purchase."""
    purchases = table(spark, sf_dir, "events").filter("event_type = 'purchase'").select(
        "event_id", "user_id", "ts", (F.col("value") > 50).alias("large"))
    order = [F.desc("event_id")]
    views = _readings(spark, sf_dir, "view").select("user_id", "ts", "event_id", F.col("value").alias("view_value"), F.col("k").alias("view_k"))
    clicks = _readings(spark, sf_dir, "click").select("user_id", "ts", "event_id", F.col("value").alias("click_value"))
    out = HT.training_set_as_of(purchases, [
        HT.History(views, ["user_id"], "ts", ["view_value", "view_k"], order),
        HT.History(clicks, ["user_id"], "ts", ["click_value"], order, "3 days")], "large", "ts", exclude=["user_id"])
    return out


def _commit(day):
    return F.lit(f"2024-03-{day:02d}").cast("timestamp")


def _feature_versions(spark, sf_dir):
    """A feature table of users in three versions: totals of two weeks each, the second with one more column."""
    path, = folders(spark, "features", "users")
    events = table(spark, sf_dir, "events")
    for day, start, stop in ((1, "2024-01-01", "2024-01-11"), (11, "2024-01-11", "2024-01-21"), (21, "2024-01-21", "2024-02-01")):
        part = events.filter((F.col("ts") >= start) & (F.col("ts") < stop) & (F.col("user_id") % 7 != day % 4)).groupBy("user_id").agg(
            F.count("*").alias("clicks"), F.max("event_type").alias("last_kind"))
        HT.save_features(spark, path, part.drop("last_kind") if day == 1 else part, ["user_id"], _commit(day))
    return path


def features_as_of(spark, sf_dir):
    """The feature table as it was the day after its second commit."""
    return HT.read_features(spark, _feature_versions(spark, sf_dir), ["user_id"], _commit(12))


def features_first(spark, sf_dir):
    """The feature table before its second commit: without the column that this added."""
    return HT.read_features(spark, _feature_versions(spark, sf_dir), ["user_id"], _commit(10))


def feature_versions_as_of(spark, sf_dir):
    """Orders, moved into the feature table's month, with the totals their customer had by then."""
    history = HT.feature_history(spark, _feature_versions(spark, sf_dir), ["user_id"], ["clicks", "last_kind"])
    day = F.lit("2024-02-25").cast("timestamp") + F.make_dt_interval(F.col("o_orderkey") % 35)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 200).alias("user_id"), day.alias("at"))
    found = HT.as_of_features(orders, history, "at", "committed")
    return found.select("o_orderkey", "user_id", "clicks", "last_kind", F.col("committed").cast("date").cast("string").alias("committed"))


def ml_ready(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return FT.ml_ready(docs, ["doc_id", "n_chars", "quality"])


def _predictions(spark, sf_dir):
    """Quality is the truth, the opposite of toxic the prediction."""
    return table(spark, sf_dir, "labels").select(
        F.col("quality").alias("label"), (1 - F.col("toxic")).alias("prediction"))


def confusion(spark, sf_dir):
    return metrics.confusion_matrix(_predictions(spark, sf_dir))


def label_metrics(spark, sf_dir):
    out = metrics.label_metrics(_predictions(spark, sf_dir), 1)
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


def _scored_lines(spark, sf_dir):
    """Whether a line was returned, scored by its price."""
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"), "l_extendedprice",
        (F.col("l_extendedprice") / 100000).alias("probability"))


def auc(spark, sf_dir):
    return metrics.auc(_scored_lines(spark, sf_dir), "label", "l_extendedprice").select(F.round("auc", 8).alias("auc"))


def f1_rounded(spark, sf_dir):
    return metrics.f1_rounded(_scored_lines(spark, sf_dir), "label", "probability").select(F.round("f1", 6).alias("f1"))


def mean_abs(spark, sf_dir):
    """Largest mean distance from the column's middle."""
    lines = table(spark, sf_dir, "lineitem").select(
        (F.col("l_quantity") - 25).alias("l_quantity"), (F.col("l_discount") - 0.05).alias("l_discount"),
        (F.col("l_linenumber") - 4.0).alias("l_linenumber"))
    return metrics.mean_abs(lines, lines.columns, 2).withColumn("mean_abs", F.round("mean_abs", 5))


def _lines(spark, sf_dir):
    """Readings with a status that depends on them: large discounted orders are damaged."""
    damaged = (F.col("l_discount") > 0.06) & (F.col("l_quantity") > 20)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", *SENSORS, F.when(damaged, "damaged").otherwise("healthy").alias("status"))


def _parts(spark, sf_dir):
    return sampling.split_keys(_lines(spark, sf_dir), ["l_orderkey"], [0.9, 0.1], seed=42)


def _fitted(spark, sf_dir):
    """The weighted classifier, chosen over the whole grid."""
    weighted = stats.class_weights(_parts(spark, sf_dir)[0], "status")
    pipeline = models.damage_classifier(SENSORS, "status", weight="weight")
    return models.train(pipeline, weighted, [*SENSORS, "status", "weight"])


def gbt_score(spark, sf_dir):
    """Hold-out precision, recall and F1 of the weighted classifier on the damaged rows."""
    model = _fitted(spark, sf_dir)
    return metrics.label_metrics(model.transform(_parts(spark, sf_dir)[1]), float(models.label_index(model, "damaged")))


def gbt_predictions(spark, sf_dir):
    """Every row scored and given a status."""
    return models.with_status(models.score_table(_fitted(spark, sf_dir), _lines(spark, sf_dir), ["l_orderkey", "l_linenumber"], "damaged"))


def _status_rule(spark, sf_dir, damaged):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *SENSORS, F.when(damaged, "damaged").otherwise("healthy").alias("status"))
    model = models.train(models.damage_classifier(SENSORS, "status", depths=(2,)), lines, [*SENSORS, "status"])
    return models.with_status(models.score_table(model, lines, ["l_orderkey", "l_linenumber"], "damaged")).select(
        "l_orderkey", "l_linenumber", "status")


def gbt_status_rule(spark, sf_dir):
    """A rule that trees can learn exactly, with damaged as the majority and as the minority."""
    some = _status_rule(spark, sf_dir, F.col("l_linenumber") >= 6).withColumn("damaged_are", F.lit("few"))
    return some.unionByName(_status_rule(spark, sf_dir, F.col("l_linenumber") >= 2).withColumn("damaged_are", F.lit("most")))


def gbt_saved_lookup(spark, sf_dir):
    """A saved and loaded classifier scores events whose features are looked up by key; the scores are appended to a table."""
    hours = table(spark, sf_dir, "events").select("event_id", F.hour("ts").alias("hour"), F.length("event_type").alias("letters"))
    labelled = hours.withColumn("status", F.when(F.col("hour") >= 12, "damaged").otherwise("healthy"))
    features = ["hour", "letters"]
    model = models.train(models.damage_classifier(features, "status", depths=(2,)), labelled, [*features, "status"])
    saved, out = folders(spark, "scorer", "model", "scored")
    models.save_model(model, saved)
    loaded = models.load_model(saved)
    early, late = hours.filter("event_id % 2 = 0"), hours.filter("event_id % 2 = 1")
    models.score_and_write(loaded, early, ["event_id"], out)
    looked_up = models.score_batch(loaded, late.select("event_id"), [FT.Lookup(hours, "event_id", features)], ["event_id"], "damaged")
    models.with_status(looked_up).write.mode("append").parquet(out)
    return spark.read.parquet(out).select("event_id", "status")


def feature_importance(spark, sf_dir):
    return models.feature_importance(_fitted(spark, sf_dir), SENSORS)


def importance_top(spark, sf_dir):
    """The two heaviest features are those of the rule, and all weights sum to one."""
    weights = models.feature_importance(_fitted(spark, sf_dir), SENSORS).collect()
    lines = table(spark, sf_dir, "lineitem").agg(F.count("*").alias("n_rows"))
    return lines.select("n_rows", F.lit(",".join(sorted(w["feature"] for w in weights[:2]))).alias("top"),
                        F.lit(round(sum(w["weight"] for w in weights), 6)).alias("total"))


def _shapley(spark, sf_dir):
    model = _fitted(spark, sf_dir)
    ready = model.transform(_lines(spark, sf_dir)).withColumn("margin", vector_to_array("rawPrediction")[1])
    return attribution.shapley(ready, models.best_trees(model), SENSORS, keep=["l_orderkey", "margin"])


def shapley(spark, sf_dir):
    """Attribution of every row; ``gap`` is what is missing to the model's margin."""
    out = _shapley(spark, sf_dir)
    total = sum((F.col(f"{f}_shap") for f in SENSORS), F.col("base"))
    return out.withColumn("gap", F.round(F.abs(total - F.col("margin")), 6))


def shapley_additivity(spark, sf_dir):
    """Every row is explained, and nothing is missing to its margin."""
    return shapley(spark, sf_dir).agg(F.count("*").alias("n"), F.max("gap").alias("max_gap"))


def shapley_top(spark, sf_dir):
    return metrics.mean_abs(_shapley(spark, sf_dir), [f"{f}_shap" for f in SENSORS], 6)


def parameter_search(spark, sf_dir):
    _, found = models.random_search(_lines(spark, sf_dir), SENSORS, "status")
    return found.orderBy(F.desc("auc"))


def split_counts(spark, sf_dir):
    """Sizes of a key-stable 90/10 split and of a 1 % sample."""
    events = table(spark, sf_dir, "events")
    parts = [*sampling.split_keys(events, ["event_id"], [0.9, 0.1], 42), sampling.sample_keys(events, ["event_id"], 0.01, 123)]
    counts = [p.agg(F.count("*").alias("n")).select(F.lit(name).alias("part"), "n")
              for p, name in zip(parts, ("train", "test", "sample"))]
    return counts[0].union(counts[1]).union(counts[2])


def split_complete(spark, sf_dir):
    """The parts of a split together are the table again."""
    train, test = sampling.split_keys(table(spark, sf_dir, "events"), ["event_id"], [0.9, 0.1], 42)
    return train.union(test).select("event_id", "event_type")


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each supplier is a run: mean discount as AUC, share of returns as F1; those in debt failed."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.round(F.avg("l_discount"), 6).alias("auc"),
        F.round(F.avg((F.col("l_returnflag") == "R").cast("int")), 6).alias("F1"))
    suppliers = table(spark, sf_dir, "supplier").withColumnRenamed("s_suppkey", "l_suppkey")
    return suppliers.join(lines, "l_suppkey").select(
        F.col("s_nationkey").cast("string").alias("experiment_id"), F.col("s_name").alias("run_id"),
        F.when(F.col("s_acctbal") < 0, "FAILED").otherwise("FINISHED").alias("status"),
        F.concat(F.lit("runs/"), "l_suppkey").alias("artifact_uri"),
        F.create_map(F.lit("auc"), "auc", F.lit("F1"), "F1").alias("metrics"))


def leaderboard(spark, sf_dir):
    return runs.leaderboard(_runs(spark, sf_dir))


def runs_stored(spark, sf_dir):
    """The board of runs that are kept as a table with a map of metrics."""
    path, = folders(spark, "runs", "runs")
    _runs(spark, sf_dir).write.parquet(path)
    return runs.leaderboard(files.read_runs(spark, path))


def best_run(spark, sf_dir):
    return runs.best_run(_runs(spark, sf_dir)).select("run_id", "artifact_uri")


QUERIES = {f.__name__: f for f in (
    class_balance, summary_stats, missing_counts, drop_null_columns, corr_matrix, class_weights, deduplicated,
    minmax_scaled, cluster_profile, kmeans_elbow, kmeans_costs, exact_quartiles, segments, segments_udf, segments_agree, time_features, training_set, merge_features,
    training_set_as_of, features_as_of, features_first, feature_versions_as_of,
    ml_ready, confusion, label_metrics, auc, f1_rounded, mean_abs, gbt_score, gbt_predictions, gbt_status_rule, gbt_saved_lookup, feature_importance, importance_top,
    shapley, shapley_additivity, shapley_top, parameter_search, split_counts, split_complete,
    leaderboard, runs_stored, best_run)}

_CORR = " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem"
                           for a in MEASURES for b in MEASURES)
_SUMMARY = " UNION ALL ".join(f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean,
    round(stddev_samp({c}), 4) AS stddev, min({c}) AS min,
    quantile_disc({c}, 0.25) AS p25, quantile_disc({c}, 0.5) AS p50, quantile_disc({c}, 0.75) AS p75, max({c}) AS max FROM lineitem""" for c in MEASURES)
_TIMES = """WITH t AS (SELECT event_id, event_type, value, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
    2 * pi() * month(ts) / 12 AS m, 2 * pi() * hour(ts) / 24 AS h,
    CAST(dayofweek(ts) IN (0, 6) AS INTEGER) AS is_weekend FROM events) """
_COUNTS = """SELECT count(*) FILTER (WHERE said AND is_) AS tp, count(*) FILTER (WHERE said AND NOT is_) AS fp,
    count(*) FILTER (WHERE NOT said AND is_) AS fn"""
_RUNS = """WITH r AS (
  SELECT CAST(s_nationkey AS VARCHAR) AS experiment_id, s_name AS run_id, 'runs/' || s_suppkey AS artifact_uri, auc, f1
  FROM supplier JOIN (SELECT l_suppkey, round(avg(l_discount), 6) AS auc,
                             round(avg(CAST(l_returnflag = 'R' AS INTEGER)), 6) AS f1 FROM lineitem GROUP BY 1)
       ON s_suppkey = l_suppkey
  WHERE s_acctbal >= 0) """
_READINGS = """WITH r AS (
  SELECT user_id, ts, event_id, event_type, value, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, ts, event_type ORDER BY event_id DESC) = 1) """
_FEATURES = """WITH w AS (
  SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 0 WHEN ts < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END AS v FROM events),
parts AS (
  SELECT user_id, v, count(*) AS clicks, CASE WHEN v > 0 THEN max(event_type) END AS last_kind FROM w
  WHERE user_id % 7 <> CASE v WHEN 1 THEN 3 ELSE 1 END GROUP BY user_id, v),
log AS (
  SELECT *, DATE '2024-03-01' + CAST(10 * v AS INTEGER) AS committed FROM parts
  WINDOW p AS (PARTITION BY user_id ORDER BY v)
  QUALIFY lag(clicks) OVER p IS DISTINCT FROM clicks OR lag(last_kind) OVER p IS DISTINCT FROM last_kind) """

ORACLE = {
    "training_set_as_of": _READINGS + """SELECT p.event_id, p.ts, v.value AS view_value, v.k AS view_k,
            CASE WHEN c.ts >= p.ts - INTERVAL 3 DAY THEN c.value END AS click_value, p.value > 50 AS large
        FROM (SELECT * FROM events WHERE event_type = 'purchase') p
        ASOF LEFT JOIN (SELECT * FROM r WHERE event_type = 'view') v ON p.user_id = v.user_id AND p.ts >= v.ts
        ASOF LEFT JOIN (SELECT * FROM r WHERE event_type = 'click') c ON p.user_id = c.user_id AND p.ts >= c.ts""",
    "features_as_of": _FEATURES + """SELECT user_id, clicks, last_kind FROM log WHERE v <= 1
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY v DESC) = 1""",
    "features_first": _FEATURES + "SELECT user_id, clicks FROM log WHERE v = 0",
    "feature_versions_as_of": _FEATURES + """SELECT o_orderkey, o.user_id, clicks, last_kind, CAST(committed AS VARCHAR) AS committed
        FROM (SELECT o_orderkey, o_custkey % 200 AS user_id, DATE '2024-02-25' + CAST(o_orderkey % 35 AS INTEGER) AS at FROM orders) o
        ASOF LEFT JOIN log ON o.user_id = log.user_id AND o.at >= log.committed""",
    "kmeans_costs": """WITH d AS (SELECT i, CAST(embedding[i] AS DOUBLE) AS x FROM embeddings, range(1, 65) r(i)),
        c AS (SELECT sum(100 * s / (hi - lo) / (hi - lo)) AS cost FROM
              (SELECT i, var_pop(x) * count(*) AS s, min(x) AS lo, max(x) AS hi FROM d GROUP BY 1))
        SELECT CAST(k AS INTEGER) AS k, (SELECT count(*) FROM embeddings) AS n, CASE WHEN k = 1 THEN round(cost, 3) END AS cost,
               CASE WHEN k > 1 THEN TRUE END AS falls FROM c, range(1, 10) r(k)""",
    "exact_quartiles": "WITH t AS (SELECT l_extendedprice, l_extendedprice + l_orderkey / 1048576 + l_linenumber / 8 AS own FROM lineitem) "
        + " UNION ALL ".join(f"""SELECT '{c}' AS "column", CAST({p} AS DOUBLE) AS probability, quantile_disc({c}, {p}) AS value FROM t"""
                             for c in ("l_extendedprice", "own") for p in (0.25, 0.5, 0.75)),
    "segments_agree": "SELECT vec_id, TRUE AS is_nearest, TRUE AS is_same FROM embeddings",
    "importance_top": "SELECT count(*) AS n_rows, 'l_discount,l_quantity' AS top, 1.0::DOUBLE AS total FROM lineitem",
    "split_complete": "SELECT event_id, event_type FROM events",
    "gbt_status_rule": """SELECT l_orderkey, l_linenumber, damaged_are, CASE WHEN l_linenumber >= cut THEN 'damaged' ELSE 'healthy' END AS status
        FROM lineitem, (VALUES ('few', 6), ('most', 2)) v(damaged_are, cut)""",
    "split_counts": """WITH s AS (SELECT CAST('0x' || substr(md5('42|' || event_id), 1, 15) AS BIGINT) AS a,
            CAST('0x' || substr(md5('123|' || event_id), 1, 15) AS BIGINT) AS b FROM events)
        SELECT part, n FROM (SELECT count(*) FILTER (WHERE a < 1037629354146162304) AS train,
            count(*) FILTER (WHERE a >= 1037629354146162304) AS test, count(*) FILTER (WHERE b < 11529215046068470) AS sample FROM s)
        UNPIVOT (n FOR part IN (train, test, sample))""",
    "shapley_additivity": "SELECT count(*) AS n, 0.0::DOUBLE AS max_gap FROM lineitem",
    "class_balance": "SELECT l_returnflag, count(*) AS count FROM lineitem GROUP BY 1",
    "summary_stats": _SUMMARY,
    "missing_counts": """WITH j AS (SELECT d.doc_id, lang, source, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id))
        SELECT unnest(['doc_id', 'lang', 'source', 'quality', 'toxic']) AS "column",
               unnest([count(*) - count(doc_id), count(*) - count(lang), count(*) - count(source),
                       count(*) - count(quality), count(*) - count(toxic)]) AS missing FROM j""",
    "drop_null_columns": "SELECT doc_id, lang FROM documents",
    "corr_matrix": _CORR,
    "class_weights": """SELECT doc_id, toxic, round(1.0 / CAST(count(*) OVER (PARTITION BY toxic) AS DOUBLE), 9) AS weight
        FROM labels""",
    "deduplicated": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) = 1""",
    "minmax_scaled": """SELECT c_custkey,
        round((c_acctbal - min(c_acctbal) OVER ()) / (max(c_acctbal) OVER () - min(c_acctbal) OVER ()) * 10, 6) AS balance,
        round(CAST(c_nationkey - min(c_nationkey) OVER () AS DOUBLE)
              / (max(c_nationkey) OVER () - min(c_nationkey) OVER ()) * 10, 6) AS nation FROM customer""",
    "cluster_profile": """SELECT label, CAST(i AS INTEGER) AS dim, round(avg(CAST(embedding[i + 1] AS DOUBLE)), 5) AS mean
        FROM embeddings, range(64) r(i) GROUP BY 1, 2""",
    "time_features": _TIMES + """SELECT event_id, round(cos(m), 6) AS cos_month, round(sin(m), 6) AS sin_month,
        round(cos(h), 6) AS cos_hour, round(sin(h), 6) AS sin_hour, is_weekend FROM t""",
    "training_set": _TIMES + """SELECT event_id, value, k,
        CASE WHEN event_type <> 'view' THEN round(cos(m), 6) END AS cos_month,
        CASE WHEN event_type <> 'view' THEN round(sin(m), 6) END AS sin_month,
        CASE WHEN event_type <> 'view' THEN round(cos(h), 6) END AS cos_hour,
        CASE WHEN event_type <> 'view' THEN round(sin(h), 6) END AS sin_hour,
        event_type = 'error' AS damaged FROM t""",
    "merge_features": _TIMES + """SELECT event_id,
        round(CASE WHEN event_type = 'click' THEN 1 ELSE 2 END * cos(h), 6) AS cos_hour,
        CASE WHEN event_type <> 'click' THEN is_weekend END AS is_weekend FROM t""",
    "ml_ready": "SELECT doc_id, n_chars, quality FROM documents JOIN labels USING (doc_id)",
    "confusion": """SELECT quality AS label, 1 - toxic AS prediction, count(*) AS count FROM labels GROUP BY 1, 2""",
    "label_metrics": f"""WITH p AS (SELECT toxic = 0 AS said, quality = 1 AS is_ FROM labels), c AS ({_COUNTS} FROM p)
        SELECT round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
               round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM c""",
    "auc": """WITH r AS (SELECT l_returnflag = 'R' AS pos, l_extendedprice AS s FROM lineitem),
        c AS (SELECT s, count(*) FILTER (WHERE pos) AS p, count(*) FILTER (WHERE NOT pos) AS n FROM r GROUP BY 1),
        w AS (SELECT p, n, sum(n) OVER (ORDER BY s) - n AS below FROM c)
        SELECT round(CAST(sum(p * (below + n / 2)) AS DOUBLE) / (CAST(sum(p) AS DOUBLE) * CAST(sum(n) AS DOUBLE)), 8) AS auc FROM w""",
    "f1_rounded": f"""WITH p AS (SELECT round_even(l_extendedprice / 100000, 0) = 1 AS said, l_returnflag = 'R' AS is_
        FROM lineitem), c AS ({_COUNTS} FROM p) SELECT round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM c""",
    "mean_abs": """SELECT * FROM (
        SELECT round(avg(abs(l_quantity - 25)), 5) AS mean_abs, 'l_quantity' AS "column" FROM lineitem
        UNION ALL SELECT round(avg(abs(l_discount - 0.05)), 5), 'l_discount' FROM lineitem
        UNION ALL SELECT round(avg(abs(l_linenumber - 4.0::DOUBLE)), 5), 'l_linenumber' FROM lineitem)
        ORDER BY 1 DESC LIMIT 2""",
    "gbt_saved_lookup": "SELECT event_id, CASE WHEN hour(ts) >= 12 THEN 'damaged' ELSE 'healthy' END AS status FROM events",
    "runs_stored": _RUNS + "SELECT experiment_id, run_id, auc, f1 AS F1, artifact_uri FROM r",
    "leaderboard": _RUNS + "SELECT experiment_id, run_id, auc, f1 AS F1, artifact_uri FROM r",
    "best_run": _RUNS + "SELECT run_id, artifact_uri FROM r WHERE f1 > 0 ORDER BY f1 DESC, run_id LIMIT 1",
}
