"""Sales forecasts per key.

Every job starts from one total per key and day. That fold has map-side combine, so
a series is bounded by the number of days it spans, however many rows a key holds.
"""

from __future__ import annotations

import random
from collections.abc import Sequence
from dataclasses import asdict
from statistics import NormalDist

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import weekday_sun0
from tidemark.operators import additive
from tidemark.operators.additive import Params
from tidemark.session import materialize

EPOCH = "2000-01-01"  # origin of the day number, any fixed date will do

# The columns of a forecast, in their published order.
FORECAST_COLUMNS = [
    "trend", "yhat_lower", "yhat_upper", "trend_lower", "trend_upper",
    "multiplicative_terms", "multiplicative_terms_lower", "multiplicative_terms_upper",
    "weekly", "weekly_lower", "weekly_upper", "yearly", "yearly_lower", "yearly_upper",
    "additive_terms", "additive_terms_lower", "additive_terms_upper", "yhat",
]


def daily_series(df: DataFrame, keys: Sequence[str], day: str, value: str) -> DataFrame:
    """(keys, ds, y): total per key and day; rows with a NULL are left out."""
    return (df.select(*keys, F.to_date(day).alias("ds"), F.col(value).cast("double").alias("y"))
              .dropna().groupBy(*keys, "ds").agg(F.sum("y").alias("y")))


def stored_series(df: DataFrame, keys: Sequence[str], day: str, value: str) -> DataFrame:
    """``daily_series`` written to the shared folder once.

    The native forecasts read the series several times; this keeps it to one scan of the sales.
    """
    return materialize(daily_series(df, keys, day, value), "series")


def future_frame(series: DataFrame, keys: Sequence[str], steps: int) -> DataFrame:
    """The dates of the history plus ``steps`` daily ones per key."""
    ahead = (series.groupBy(*keys).agg(F.max("ds").alias("last"))
                   .select(*keys, F.explode(F.sequence(F.date_add("last", 1), F.date_add("last", steps))).alias("ds")))
    return series.select(*keys, "ds").unionByName(ahead)


# ------------------------------------------------- native: line × weekday index

def _day_number(day) -> "F.Column":
    return F.datediff(day, F.lit(EPOCH).cast("date"))


def _fit_line(train: DataFrame, keys: Sequence[str]) -> DataFrame:
    t = _day_number("ds")
    return train.groupBy(*keys).agg(F.regr_slope("y", t).alias("slope"), F.regr_intercept("y", t).alias("level"))


def _weekday_index(train: DataFrame, line: DataFrame, keys: Sequence[str]) -> DataFrame:
    ratio = F.try_divide(F.col("y"), F.col("level") + F.col("slope") * _day_number("ds"))
    return (train.join(line, list(keys)).groupBy(*keys, weekday_sun0("ds").alias("weekday"))
                 .agg(F.avg(ratio).alias("index")))


def _predict(frame: DataFrame, line: DataFrame, index: DataFrame, keys: Sequence[str]) -> DataFrame:
    trend = F.col("level") + F.col("slope") * _day_number("ds")
    return (frame.withColumn("weekday", weekday_sun0("ds"))
                 .join(line, list(keys), "left").join(index, [*keys, "weekday"], "left")
                 .withColumn("trend", trend)
                 .withColumn("yhat", F.col("trend") * F.coalesce("index", F.lit(1.0)))
                 .drop("weekday", "slope", "level", "index"))


def seasonal_trend(series: DataFrame, keys: Sequence[str], steps: int) -> DataFrame:
    """History and ``steps`` days ahead from a straight line times a weekday index."""
    line = _fit_line(series, keys)
    return _predict(future_frame(series, keys, steps), line, _weekday_index(series, line, keys), keys)


def cutoffs(series: DataFrame, keys: Sequence[str], initial: int, period: int, horizon: int) -> DataFrame:
    """Forecast origins per key: back from the last possible one, ``initial`` days of history at least."""
    span = series.groupBy(*keys).agg(F.date_add(F.min("ds"), initial).alias("first"),
                                     F.date_sub(F.max("ds"), horizon).alias("last"))
    step = F.expr(f"INTERVAL -{int(period)} DAYS")
    return (span.filter("first <= last")
                .select(*keys, F.explode(F.sequence(F.col("last"), F.col("first"), step)).alias("cutoff")))


def rolling_cv(series: DataFrame, keys: Sequence[str], initial: int = 730, period: int = 90,
               horizon: int = 180, interval_width: float = 0.95) -> DataFrame:
    """Fit before each cut-off, predict the ``horizon`` days after it.

    Returns (keys, cutoff, ds, y, yhat, yhat_lower, yhat_upper); the interval is that of
    normal errors as large as those of the fit. The model is that of ``seasonal_trend``, solved
    for all cut-offs of a series at once: its days are read once, not once per cut-off.
    """
    z = NormalDist().inv_cdf(0.5 + interval_width / 2)
    schema = T.StructType([series.schema[k] for k in keys]
                          + [T.StructField(c, T.DateType()) for c in ("cutoff", "ds")]
                          + [T.StructField(c, T.DoubleType()) for c in ("y", "yhat", "yhat_lower", "yhat_upper")])
    return additive.per_series(series, keys, schema, lambda days, y: additive.rolling_line(days, y, initial, period, horizon, z))


def forecast_metrics(cv: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """mse, rmse, mae, mape (and coverage with an interval) per horizon in days."""
    error = F.col("y") - F.col("yhat")
    aggs = [F.count("*").alias("n"), F.avg(error * error).alias("mse"), F.sqrt(F.avg(error * error)).alias("rmse"),
            F.avg(F.abs(error)).alias("mae"), F.avg(F.abs(F.try_divide(error, F.col("y")))).alias("mape")]
    if "yhat_lower" in cv.columns:
        inside = F.col("y").between(F.col("yhat_lower"), F.col("yhat_upper"))
        aggs.append(F.avg(inside.cast("int")).alias("coverage"))
    return cv.groupBy(*by, F.datediff("ds", "cutoff").alias("horizon")).agg(*aggs)


# ------------------------------------------------- additive model per key

def _forecast_schema(series: DataFrame, keys: Sequence[str]) -> T.StructType:
    return T.StructType([series.schema[k] for k in keys] + [T.StructField("ds", T.DateType())]
                        + [T.StructField(c, T.FloatType()) for c in FORECAST_COLUMNS])


def forecast_by_key(df: DataFrame, keys: Sequence[str], day: str, value: str, steps: int = 30,
                    params: Params = Params()) -> DataFrame:
    """One model per key: history and ``steps`` days ahead, with intervals and terms.

    A series is one key's daily totals, so its size is bounded by the days it spans. An Arrow
    batch holds many of them, and series of like length are solved together.
    """
    series = daily_series(df, keys, day, value)

    def solve(days: np.ndarray, y: np.ndarray, at: np.ndarray) -> additive.Solved:
        for first, found in additive.fit_predict_many(days, y, at, steps, params):
            yield first, {"ds": found["ds"], **{c: found[c].astype(np.float32) for c in FORECAST_COLUMNS}}

    return additive.per_batch(series, keys, _forecast_schema(series, keys), solve)


def search_space(trials: int = 12, seed: int = 123) -> list[Params]:
    """Random draws of the seasonality switches, the ridge weight and the interval width."""
    rng = random.Random(seed)
    return [Params(weekly=rng.random() < 0.5, yearly=rng.random() < 0.5, ridge=round(10 ** rng.uniform(-2, 2), 4),
                   interval_width=round(rng.uniform(0.5, 0.95), 4)) for _ in range(trials)]


def forecast_search(df: DataFrame, keys: Sequence[str], day: str, value: str, candidates: Sequence[Params],
                    initial: int = 730, period: int = 90, horizon: int = 180) -> DataFrame:
    """Rolling-origin error of every candidate for every key.

    All cut-offs of a series are solved together, and candidates with the same terms share
    the factorised normal matrices. Keys too short for one cut-off get a NULL error.
    """
    series = daily_series(df, keys, day, value)
    fields = ["weekly", "yearly", "ridge", "interval_width"]
    schema = T.StructType([series.schema[k] for k in keys] + [
        T.StructField("candidate", T.IntegerType()), *[T.StructField(f, T.BooleanType()) for f in fields[:2]],
        T.StructField("ridge", T.DoubleType()), T.StructField("interval_width", T.DoubleType()), T.StructField("n", T.LongType()),
        T.StructField("rmse", T.DoubleType()), T.StructField("coverage", T.DoubleType())])
    fixed = {"candidate": np.arange(len(candidates), dtype=np.int32), **{f: np.array([asdict(c)[f] for c in candidates]) for f in fields}}

    def solve(days: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        found = additive.rolling_errors(days, y, candidates, initial, period, horizon)
        return {**fixed, **{name: np.array([f[n] for f in found]) for n, name in enumerate(("n", "rmse", "coverage"))}}

    return additive.per_series(series, keys, schema, solve)


def best_candidate(results: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The candidate with the smallest error per key; the lower number wins a tie."""
    best = Window.partitionBy(*keys).orderBy(F.col("rmse").asc_nulls_last(), "candidate")
    return results.withColumn("_rank", F.row_number().over(best)).filter("_rank = 1").drop("_rank")


def item_slice(forecast: DataFrame, item: str, value, start: str, keys: Sequence[str] = ()) -> DataFrame:
    """One item's predictions from a date on, in order."""
    return (forecast.filter((F.col(item) == F.lit(value)) & (F.col("ds") >= F.lit(start).cast("date")))
                    .select(*keys, "ds", "yhat").orderBy(*keys, "ds"))
