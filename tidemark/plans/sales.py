"""Sales history: trends, seasonality, forecasts. Sales are ``lineitem`` rows by supplier and ship date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import forecast as FC
from tidemark.operators import sampling, trends
from tidemark.plans.common import folders, stream_session, table
from tidemark.session import materialize
from tidemark.sources.files import stream_files
from tidemark.streaming import live, sinks

KEY, DAY, VALUE = ["store"], "day", "sales"


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("store"), F.col("l_partkey").alias("item"),
        F.col("l_shipdate").alias("day"), F.col("l_quantity").alias("sales"))


def _text(df: DataFrame, *days: str) -> DataFrame:
    """Dates as text, the same on every client."""
    return df.withColumns({d: F.col(d).cast("string") for d in days})


def _item_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by store and item; an item is a brand."""
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("part"), F.col("p_brand").alias("item"))
    return _sales(spark, sf_dir).withColumnRenamed("item", "part").join(parts, "part").select("store", "item", "day", "sales")


def trend_year(spark, sf_dir):
    return trends.trend_by_year(_sales(spark, sf_dir), "day", "sales")


def trend_month(spark, sf_dir):
    return _text(trends.trend_by_month(_sales(spark, sf_dir), "day", "sales"), "month")


def season_weekday(spark, sf_dir):
    found = trends.seasonality_by_weekday(_sales(spark, sf_dir), "day", "sales")
    return found.withColumn("sales", F.round("sales", 4))


def daily_total(spark, sf_dir):
    return _text(trends.total_by_day(_sales(spark, sf_dir), "day", "sales", "power"), "day")


def sum_by_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("cents", F.round(F.col("o_totalprice") * 100).cast("long"))
    return trends.sum_by(orders, "o_orderpriority", "cents", "total_amount")


def sum_by_key_stream(spark, sf_dir):
    own = stream_session(spark)
    source, out, checkpoint = folders(spark, "sum", "in", "out", "checkpoint")
    table(spark, sf_dir, "orders").repartition(3).write.parquet(source)  # three micro-batches: sums must live on between them
    orders = stream_files(own, source, "parquet", table(spark, sf_dir, "orders").schema, max_files=1)
    cents = orders.withColumn("cents", F.round(F.col("o_totalprice") * 100).cast("long"))
    sinks.sink_replace(live.live_sum(cents, "o_orderpriority", "cents", "total_amount"), out, checkpoint,
                       available_now=True).awaitTermination()
    return spark.read.parquet(out)


def _series(spark, sf_dir):
    return FC.stored_series(_sales(spark, sf_dir), KEY, DAY, VALUE)


def future_frame(spark, sf_dir):
    return _text(FC.future_frame(_series(spark, sf_dir), KEY, 30), "ds")


def seasonal_trend(spark, sf_dir):
    out = FC.seasonal_trend(_series(spark, sf_dir), KEY, 30)
    return _text(out.select("store", "ds", F.round("trend", 4).alias("trend"), F.round("yhat", 4).alias("yhat")), "ds")


def cv_cutoffs(spark, sf_dir):
    return _text(FC.cutoffs(_series(spark, sf_dir), KEY, 730, 90, 180), "cutoff")


def rolling_cv(spark, sf_dir):
    out = FC.rolling_cv(_series(spark, sf_dir), KEY)
    return _text(out.select("store", "cutoff", "ds", "y", *[F.round(c, 4).alias(c) for c in ("yhat", "yhat_lower", "yhat_upper")]), "cutoff", "ds")


def cv_metrics(spark, sf_dir):
    out = FC.forecast_metrics(FC.rolling_cv(_series(spark, sf_dir), KEY))
    return out.select("horizon", "n", *[F.round(c, 4).alias(c) for c in ("mse", "rmse", "mae", "mape", "coverage")])


def forecast_by_key(spark, sf_dir):
    """One model per store and item."""
    return _text(FC.forecast_by_key(_item_sales(spark, sf_dir), ["store", "item"], DAY, VALUE, 30), "ds")


def forecast_identities(spark, sf_dir):
    """Of every forecast: its date, and whether its terms add up and its bounds lie evenly around it."""
    out = forecast_by_key(spark, sf_dir)
    near = lambda a, b: F.abs(a - b) <= 1e-3 * F.greatest(F.abs(a), F.lit(1.0))
    yhat, season = F.col("yhat").cast("double"), F.col("weekly").cast("double") + F.col("yearly")
    return out.select("store", "item", "ds", near(yhat, F.col("trend") * (1 + season)).alias("adds_up"),
                      near(F.col("yhat_upper") - yhat, yhat - F.col("yhat_lower")).alias("is_even"),
                      near(F.col("multiplicative_terms").cast("double"), season).alias("terms_match"))


def forecast_dates(spark, sf_dir):
    """The dates of the forecasts: the whole history and 30 days more per store and item."""
    return forecast_by_key(spark, sf_dir).select("store", "item", "ds")


def seasonal_trend_item(spark, sf_dir):
    """The native forecast per store and item; a series of one day has a date but no line."""
    keys = ["store", "item"]
    out = FC.seasonal_trend(FC.stored_series(_item_sales(spark, sf_dir), keys, DAY, VALUE), keys, 30)
    return _text(out.select(*keys, "ds", F.round("trend", 4).alias("trend"), F.round("yhat", 4).alias("yhat")), "ds")


def forecast_global(spark, sf_dir):
    """One line over all stores since 1995, from a tenth of them: since-date and sample are the feature."""
    recent = _sales(spark, sf_dir).filter(F.col("day") >= "1995-01-01")
    some = sampling.sample_keys(recent, ["store"], 0.1, 123).withColumn("series", F.lit("all"))
    out = FC.seasonal_trend(FC.stored_series(some, ["series"], DAY, VALUE), ["series"], 30)
    return _text(out.select("series", "ds", F.round("trend", 4).alias("trend"), F.round("yhat", 4).alias("yhat")), "ds")


def forecast_slice(spark, sf_dir):
    """One store's forecast from a date on: the slice is the feature."""
    return _text(FC.item_slice(FC.seasonal_trend(_series(spark, sf_dir), KEY, 30)
                               .withColumn("yhat", F.round("yhat", 4)), "store", 1, "2001-01-01", KEY), "ds")


CANDIDATES = FC.search_space(12)


def forecast_search(spark, sf_dir):
    found = FC.forecast_search(_sales(spark, sf_dir), KEY, DAY, VALUE, CANDIDATES)
    return FC.best_candidate(found, KEY)


def forecast_search_lines(spark, sf_dir):
    """Of the searched candidates those without seasons, whose errors SQL can compute, and whether the chosen one is no worse."""
    found = materialize(FC.forecast_search(_sales(spark, sf_dir), KEY, DAY, VALUE, CANDIDATES), "search")
    best = FC.best_candidate(found, KEY).select("store", F.col("rmse").alias("best"))
    lines = found.where("NOT weekly AND NOT yearly").join(best, "store")
    return lines.select("store", "candidate", "n", F.round("rmse", 4).alias("rmse"), F.round("coverage", 6).alias("coverage"),
                        (F.col("best") <= F.col("rmse")).alias("best_is_no_worse"))


QUERIES = {f.__name__: f for f in (
    trend_year, trend_month, season_weekday, daily_total, sum_by_key, sum_by_key_stream, future_frame,
    seasonal_trend, cv_cutoffs, rolling_cv, cv_metrics, forecast_by_key, forecast_dates, forecast_identities, seasonal_trend_item,
    forecast_global, forecast_slice, forecast_search, forecast_search_lines)}

_SUM = """SELECT o_orderpriority, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total_amount
FROM orders GROUP BY 1"""
_SERIES = """
WITH series AS (
  SELECT l_suppkey AS store, CAST(l_shipdate AS DATE) AS ds, sum(l_quantity) AS y FROM lineitem GROUP BY 1, 2)"""
_FRAME = """,
frame AS (
  SELECT store, ds FROM series
  UNION ALL
  SELECT store, CAST(last + CAST(n AS INTEGER) AS DATE) FROM (SELECT store, max(ds) AS last FROM series GROUP BY 1), range(1, 31) r(n))"""
_FIT = """,
line AS (
  SELECT store, regr_slope(y, t) AS slope, regr_intercept(y, t) AS level
  FROM (SELECT *, date_diff('day', DATE '2000-01-01', ds) AS t FROM series) GROUP BY 1),
idx AS (
  SELECT s.store, dayofweek(ds) AS weekday, avg(y / (level + slope * date_diff('day', DATE '2000-01-01', ds))) AS i
  FROM series s JOIN line USING (store) GROUP BY 1, 2),
fitted AS (
  SELECT f.store, f.ds, level + slope * date_diff('day', DATE '2000-01-01', f.ds) AS trend, coalesce(i, 1.0) AS i
  FROM frame f JOIN line USING (store) LEFT JOIN idx ON idx.store = f.store AND idx.weekday = dayofweek(f.ds))"""
_CUTS = """,
cuts AS (
  SELECT store, CAST(last - CAST(n * 90 AS INTEGER) AS DATE) AS cutoff
  FROM (SELECT store, min(ds) + 730 AS first, max(ds) - 180 AS last FROM series GROUP BY 1), range(0, 100) r(n)
  WHERE last - CAST(n * 90 AS INTEGER) >= first)"""
_CV = _SERIES + _CUTS + """,
paired AS (
  SELECT s.store, cutoff, ds, y, date_diff('day', DATE '2000-01-01', ds) AS t FROM series s JOIN cuts USING (store)),
line AS (
  SELECT store, cutoff, regr_slope(y, t) AS slope, regr_intercept(y, t) AS level
  FROM paired WHERE ds <= cutoff GROUP BY 1, 2),
idx AS (
  SELECT p.store, p.cutoff, dayofweek(ds) AS weekday, avg(y / (level + slope * t)) AS i
  FROM paired p JOIN line l ON l.store = p.store AND l.cutoff = p.cutoff WHERE ds <= p.cutoff GROUP BY 1, 2, 3),
cv AS (
  SELECT p.store, p.cutoff, p.ds, p.y, (level + slope * t) * coalesce(i, 1.0) AS yhat
  FROM paired p JOIN line l ON l.store = p.store AND l.cutoff = p.cutoff
  LEFT JOIN idx ON idx.store = p.store AND idx.cutoff = p.cutoff AND idx.weekday = dayofweek(p.ds)
  WHERE p.ds > p.cutoff AND p.ds <= p.cutoff + 180),
errors AS (
  SELECT p.store, p.cutoff, stddev_samp(y - (level + slope * t) * coalesce(i, 1.0)) * 1.959963984540054 AS half
  FROM paired p JOIN line l ON l.store = p.store AND l.cutoff = p.cutoff
  LEFT JOIN idx ON idx.store = p.store AND idx.cutoff = p.cutoff AND idx.weekday = dayofweek(p.ds)
  WHERE p.ds <= p.cutoff GROUP BY 1, 2)"""
_ITEMS = """
WITH series AS (
  SELECT l_suppkey AS store, p_brand AS item, CAST(l_shipdate AS DATE) AS ds, sum(l_quantity) AS y
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3),
frame AS (
  SELECT store, item, ds FROM series
  UNION ALL
  SELECT store, item, CAST(last + CAST(n AS INTEGER) AS DATE)
  FROM (SELECT store, item, max(ds) AS last FROM series GROUP BY 1, 2), range(1, 31) r(n))"""
_ITEM_FIT = """,
line AS (
  SELECT store, item, regr_slope(y, t) AS slope, regr_intercept(y, t) AS level
  FROM (SELECT *, date_diff('day', DATE '2000-01-01', ds) AS t FROM series) GROUP BY 1, 2),
idx AS (
  SELECT store, item, dayofweek(ds) AS weekday, avg(y / (level + slope * date_diff('day', DATE '2000-01-01', ds))) AS i
  FROM series JOIN line USING (store, item) GROUP BY 1, 2, 3),
fitted AS (
  SELECT f.store, f.item, f.ds, level + slope * date_diff('day', DATE '2000-01-01', f.ds) AS trend, coalesce(i, 1.0) AS i
  FROM frame f JOIN line USING (store, item)
  LEFT JOIN idx ON idx.store = f.store AND idx.item = f.item AND idx.weekday = dayofweek(f.ds))"""
_LINES = ", ".join(f"({n}, {c.z!r})" for n, c in enumerate(CANDIDATES) if not c.terms)
_SEARCH = _SERIES + _CUTS + f""",
paired AS (
  SELECT s.store, cutoff, ds, y, date_diff('day', DATE '2000-01-01', ds) AS t FROM series s JOIN cuts USING (store)),
line AS (
  SELECT store, cutoff, regr_slope(y, t) AS slope, regr_intercept(y, t) AS level, greatest(1e-9, 0.01 * avg(abs(y))) AS least
  FROM paired WHERE ds <= cutoff GROUP BY 1, 2 HAVING count(*) > 1),
guess AS (
  SELECT p.*, greatest(level + slope * t, least) AS yhat FROM paired p JOIN line USING (store, cutoff) WHERE ds <= cutoff + 180),
spread AS (SELECT store, cutoff, stddev_pop(y - yhat) AS s FROM guess WHERE ds <= cutoff GROUP BY 1, 2),
candidates(candidate, z) AS (VALUES {_LINES}),
errors AS (
  SELECT store, candidate, count(*) AS n, sqrt(avg((y - yhat) * (y - yhat))) AS rmse, avg(CAST(abs(y - yhat) <= z * s AS INTEGER)) AS coverage
  FROM guess JOIN spread USING (store, cutoff), candidates WHERE ds > cutoff GROUP BY 1, 2)
SELECT store, candidate, coalesce(n, 0) AS n, round(rmse, 4) AS rmse, round(coverage, 6) AS coverage,
       CASE WHEN n > 0 THEN TRUE END AS best_is_no_worse
FROM (SELECT * FROM (SELECT DISTINCT store FROM series), candidates) LEFT JOIN errors USING (store, candidate)"""
_GLOBAL = _SERIES.replace("l_suppkey AS store", "'all' AS store").replace("FROM lineitem", """FROM lineitem
  WHERE l_shipdate >= TIMESTAMP '1995-01-01' AND CAST('0x' || substr(md5('123|' || l_suppkey), 1, 15) AS BIGINT) < 115292150460684704""")

ORACLE = {
    "trend_year": """SELECT CAST(year(l_shipdate) AS INTEGER) AS year, sum(l_quantity) AS sales
        FROM lineitem GROUP BY 1 ORDER BY 1""",
    "trend_month": """SELECT strftime(date_trunc('month', l_shipdate), '%Y-%m-%d') AS month, sum(l_quantity) AS sales
        FROM lineitem GROUP BY 1 ORDER BY 1""",
    "season_weekday": """SELECT CAST(year(d) AS INTEGER) AS year, CAST(dayofweek(d) AS INTEGER) AS weekday,
        round(avg(total), 4) AS sales
        FROM (SELECT CAST(l_shipdate AS DATE) AS d, sum(l_quantity) AS total FROM lineitem GROUP BY 1)
        GROUP BY 1, 2 ORDER BY 1, 2""",
    "daily_total": """SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, sum(l_quantity) AS power
        FROM lineitem GROUP BY 1""",
    "sum_by_key": _SUM,
    "sum_by_key_stream": _SUM,
    "future_frame": _SERIES + _FRAME + "SELECT store, CAST(ds AS VARCHAR) AS ds FROM frame",
    "forecast_dates": _ITEMS + "SELECT store, item, CAST(ds AS VARCHAR) AS ds FROM frame",
    "forecast_identities": _ITEMS + """
        SELECT store, item, CAST(ds AS VARCHAR) AS ds, TRUE AS adds_up, TRUE AS is_even, TRUE AS terms_match FROM frame""",
    "seasonal_trend_item": _ITEMS + _ITEM_FIT + """
        SELECT store, item, CAST(ds AS VARCHAR) AS ds, round(trend, 4) AS trend, round(trend * i, 4) AS yhat FROM fitted""",
    "forecast_global": _GLOBAL + _FRAME + _FIT + """
        SELECT store AS series, CAST(ds AS VARCHAR) AS ds, round(trend, 4) AS trend, round(trend * i, 4) AS yhat FROM fitted""",
    "seasonal_trend": _SERIES + _FRAME + _FIT + """
        SELECT store, CAST(ds AS VARCHAR) AS ds, round(trend, 4) AS trend, round(trend * i, 4) AS yhat FROM fitted""",
    "cv_cutoffs": _SERIES + _CUTS + "SELECT store, CAST(cutoff AS VARCHAR) AS cutoff FROM cuts",
    "rolling_cv": _CV + """SELECT store, CAST(cutoff AS VARCHAR) AS cutoff, CAST(ds AS VARCHAR) AS ds, y,
        round(yhat, 4) AS yhat, round(yhat - half, 4) AS yhat_lower, round(yhat + half, 4) AS yhat_upper
        FROM cv LEFT JOIN errors USING (store, cutoff)""",
    "cv_metrics": _CV + """SELECT CAST(date_diff('day', cutoff, ds) AS INTEGER) AS horizon, count(*) AS n,
        round(avg((y - yhat) * (y - yhat)), 4) AS mse, round(sqrt(avg((y - yhat) * (y - yhat))), 4) AS rmse,
        round(avg(abs(y - yhat)), 4) AS mae, round(avg(abs((y - yhat) / nullif(y, 0))), 4) AS mape,
        round(avg(CAST(y BETWEEN yhat - half AND yhat + half AS INTEGER)), 4) AS coverage
        FROM cv LEFT JOIN errors USING (store, cutoff) GROUP BY 1""",
    "forecast_search_lines": _SEARCH,
    "forecast_slice": _SERIES + _FRAME + _FIT + """
        SELECT store, CAST(ds AS VARCHAR) AS ds, round(trend * i, 4) AS yhat FROM fitted
        WHERE store = 1 AND ds >= DATE '2001-01-01'""",
}
