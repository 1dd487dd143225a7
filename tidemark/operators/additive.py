"""Many small regressions per Arrow batch: additive models and rolling evaluations of whole series.

Rows arrive sorted by series and day. A batch holds many series. Forecasts are solved for blocks
of series at once; evaluations for all cut-offs of a series, as matrices of cut-offs by days, so no
row is repeated per cut-off and no Python object is made per row. A series is bounded by the days it spans.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Periods in days and Fourier orders of the weekly and the yearly term.
PERIODS = {"weekly": (7.0, 3), "yearly": (365.25, 10)}
TURNS = 3  # rounds of line and season
FLUSH_ROWS = 1 << 16


@dataclass(frozen=True)
class Params:
    """Model switches. Seasonal terms multiply the trend."""

    weekly: bool = True
    yearly: bool = True
    ridge: float = 0.1           # of the seasonal weights
    interval_width: float = 0.95

    @property
    def terms(self) -> tuple[str, ...]:
        return tuple(name for name in PERIODS if getattr(self, name))

    @property
    def z(self) -> float:
        return NormalDist().inv_cdf(0.5 + self.interval_width / 2)


def fourier(days: np.ndarray, name: str) -> np.ndarray:
    period, order = PERIODS[name]
    angle = 2 * math.pi * np.outer(days, np.arange(1, order + 1)) / period
    return np.hstack([np.cos(angle), np.sin(angle)])


# ------------------------------------------------- series out of sorted batches

def whole_series(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of complete series, with the bounds of each; a series cut by a batch border is joined again."""
    rest: pa.RecordBatch | None = None

    def bounds(batch: pa.RecordBatch) -> np.ndarray:
        new = np.zeros(batch.num_rows, bool)
        new[0] = True
        for key in keys:
            column = batch.column(key)
            new[1:] |= np.array(pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)))
        return np.append(np.flatnonzero(new), batch.num_rows)

    for batch in batches:
        if not batch.num_rows:
            continue
        if rest is not None:
            batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        at = bounds(batch)
        rest = batch.slice(at[-2])
        if len(at) > 2:
            yield batch.slice(0, at[-2]), at[:-1]
    if rest is not None:
        yield rest, np.array([0, rest.num_rows])


Solved = Iterator[tuple[np.ndarray, dict[str, np.ndarray]]]


def per_batch(series: DataFrame, keys: Sequence[str], schema: T.StructType,
              solve: Callable[[np.ndarray, np.ndarray, np.ndarray], Solved]) -> DataFrame:
    """``solve(days, y, bounds)`` for whole series of ``series(keys, ds, y)``; its columns, with the keys before them.

    It yields, per block of results, the first row of each result's series and the columns. Days are
    numbers since 1970. NaN becomes NULL. One shuffle by key of rows that are already totals.
    """
    names = [f.name for f in schema if f.name not in keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, at in whole_series(batches, keys):
            days = batch.column("ds").cast(pa.int32()).to_numpy().astype(np.int64)
            y = batch.column("y").to_numpy(zero_copy_only=False)
            for first, found in solve(days, y, at):
                place = pa.array(first)
                columns = [batch.column(k).take(place) for k in keys]
                for name in names:
                    if isinstance(schema[name].dataType, T.DateType):
                        columns.append(pa.array(found[name].astype(np.int32)).cast(pa.date32()))
                    else:
                        columns.append(pa.array(found[name], from_pandas=True))
                yield pa.RecordBatch.from_arrays(columns, [*keys, *names])

    return series.select(*keys, "ds", "y").repartition(*keys).sortWithinPartitions(*keys, "ds").mapInArrow(run, schema)


def per_series(series: DataFrame, keys: Sequence[str], schema: T.StructType,
               solve: Callable[[np.ndarray, np.ndarray], dict[str, np.ndarray]]) -> DataFrame:
    """``solve(days, y)`` for one series after the other; see ``per_batch``."""
    def one_by_one(days: np.ndarray, y: np.ndarray, at: np.ndarray) -> Solved:
        first, found, rows = [], [], 0
        for n, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
            out = solve(days[a:b], y[a:b])
            size = len(next(iter(out.values())))
            if size:
                first.append(np.full(size, a))
                found.append(out)
                rows += size
            if rows and (rows >= FLUSH_ROWS or n == len(at) - 2):
                yield np.concatenate(first), {name: np.concatenate([o[name] for o in found]) for name in found[0]}
                first, found, rows = [], [], 0

    return per_batch(series, keys, schema, one_by_one)


# ------------------------------------------------- line times weekday index, evaluated at cut-offs

def cut_days(days: np.ndarray, initial: int, period: int, horizon: int) -> np.ndarray:
    """Forecast origins: back from the last possible one, ``initial`` days of history at least."""
    return np.arange(days[-1] - horizon, days[0] + initial - 1, -period)


def rolling_line(days: np.ndarray, y: np.ndarray, initial: int, period: int, horizon: int, z: float) -> dict[str, np.ndarray]:
    """Line and weekday index before each cut-off, predictions for the ``horizon`` days after it.

    Running sums give the means at every cut-off; the rest is sums over a matrix of cut-offs by days.
    """
    cuts = cut_days(days, initial, period, horizon)
    past = np.searchsorted(days, cuts, "right")
    keep = past > 0
    cuts, past = cuts[keep], past[keep]
    used = np.arange(len(days)) < past[:, None]
    running = lambda v: np.cumsum(v)[past - 1]
    with np.errstate(divide="ignore", invalid="ignore"):
        mean_t, mean_y = running(days - days[0]) / past + days[0], running(y) / past
        away = (days - mean_t[:, None]) * used
        square = (away * away).sum(axis=1)
        slope = np.where(square > 0, (away * (y - mean_y[:, None])).sum(axis=1) / square, np.nan)
        line = mean_y[:, None] + slope[:, None] * (days - mean_t[:, None])
        ratio = np.where(used & (line != 0), y / line, 0.0)
        weekday = np.eye(7)[(days + 4) % 7]
        count = (used & (line != 0)).astype(float) @ weekday
        index = np.where(count > 0, np.where(np.isfinite(ratio), ratio, 0) @ weekday / np.maximum(count, 1), 1.0)
        guess = line * (index @ weekday.T)
        error = np.where(used, y - guess, 0.0)
        centred = np.where(used, error - (error.sum(axis=1) / past)[:, None], 0.0)
        half = z * np.sqrt(np.where(past > 1, (centred * centred).sum(axis=1) / (past - 1), np.nan))
    c, d = np.nonzero((days > cuts[:, None]) & (days <= cuts[:, None] + horizon))
    return {"cutoff": cuts[c], "ds": days[d], "y": y[d], "yhat": guess[c, d], "yhat_lower": guess[c, d] - half[c],
            "yhat_upper": guess[c, d] + half[c]}


# ------------------------------------------------- trend line times Fourier seasons

class Fits:
    """Models of one series for several training lengths (``past`` first days) and several ``Params``.

    The normal matrix of each length is a difference of running sums and is factorised once for
    every set of terms; all ridge weights and interval widths share it.
    """

    def __init__(self, days: np.ndarray, y: np.ndarray, past: np.ndarray):
        self.days, self.y, self.past = days, y, past
        self.used = np.arange(len(days)) < past[:, None]
        self.start = days[0]
        self.span = np.maximum(1, days[past - 1] - days[0])
        self.u = (days - self.start) / self.span[:, None]
        self.floor = np.maximum(1e-9, 0.01 * np.cumsum(np.abs(y))[past - 1] / past)
        self.mean_u = (self.u * self.used).sum(axis=1) / past
        self.away = (self.u - self.mean_u[:, None]) * self.used
        self.square = (self.away * self.away).sum(axis=1)
        self.known = np.where(self.used, y, 0.0)
        self.centred = self.u - self.mean_u[:, None]
        self.found: dict[tuple, tuple] = {}
        self.design = {name: fourier(days, name) for name in PERIODS}
        self.factors: dict[tuple[str, ...], tuple] = {}

    def factor(self, terms: tuple[str, ...]) -> tuple:
        if terms not in self.factors:
            design = np.hstack([self.design[t] for t in terms])
            order = np.argsort(self.past, kind="stable")
            normal = np.zeros((len(self.past), design.shape[1], design.shape[1]))
            total, done = np.zeros(normal.shape[1:]), 0
            for n in order.tolist():
                part = design[done: self.past[n]]
                total = total + part.T @ part
                normal[n], done = total, max(done, int(self.past[n]))
            self.factors[terms] = (design, *np.linalg.eigh(normal))
        return self.factors[terms]

    def line(self, season: np.ndarray | float) -> tuple[np.ndarray, np.ndarray]:
        """Least squares through the data without the season: mean and slope per training length."""
        value = self.known / np.maximum(1 + season, 0.05)
        mean = value.sum(axis=1) / self.past
        value -= mean[:, None]
        return mean, np.einsum("cl,cl->c", self.away, value) / np.where(self.square > 0, self.square, 1.0)

    def trend(self, fit: tuple, centred: np.ndarray) -> np.ndarray:
        line = fit[1][:, None] * centred
        line += fit[0][:, None]
        return np.maximum(line, self.floor[:, None], out=line)

    def solve(self, params: Params) -> tuple:
        """Mean, slope, seasonal weights, line and season at all days, the deviation of the data from the fit.

        Line and season are fitted in turns, each against the data without the other. The interval
        width changes nothing here, nor does the ridge without seasonal terms.
        """
        terms, season = params.terms, np.zeros_like(self.u)
        which = terms, params.ridge if terms else None
        if which in self.found:
            return self.found[which]
        weights = np.zeros((len(self.past), 0))
        for _ in range(TURNS if terms else 1):
            fit = self.line(season)
            line = self.trend(fit, self.centred)
            if terms:
                design, value, vector = self.factor(terms)
                right = (self.known / line - self.used) @ design
                inner = np.einsum("cji,cj->ci", vector, right) / (value + params.ridge)
                weights = np.einsum("cij,cj->ci", vector, inner)
                season = weights @ design.T
        self.found[which] = (*fit, weights, line, season, self.std(line * (1 + season)))
        return self.found[which]

    def std(self, fitted: np.ndarray) -> np.ndarray:
        error = (self.y - fitted) * self.used
        error -= (error.sum(axis=1) / self.past)[:, None]
        error *= self.used
        return np.sqrt(np.einsum("cl,cl->c", error, error) / self.past)


def seasons(params: Params, weights: np.ndarray, days: np.ndarray) -> dict[str, np.ndarray]:
    """The effect of every term for each row of weights at ``days``; zero for a term that is off."""
    out, at = {name: np.zeros((len(weights), len(days))) for name in PERIODS}, 0
    for name in params.terms:
        basis = fourier(days, name)
        out[name] = weights[:, at: at + basis.shape[1]] @ basis.T
        at += basis.shape[1]
    return out


def fit_predict(days: np.ndarray, y: np.ndarray, at: np.ndarray, params: Params) -> dict[str, np.ndarray]:
    """One series' model, evaluated at the days ``at``, with intervals and terms."""
    fits = Fits(days, y, np.array([len(days)]))
    fit = fits.solve(params)
    u = (at - fits.start) / fits.span[:, None]
    trend = fits.trend(fit, u - fits.mean_u[:, None])[0]
    effect = {name: values[0] for name, values in seasons(params, fit[2], at).items()}
    square, away = fits.square[0], u[0] - fits.mean_u[0]
    leverage = 1 / len(days) + (away * away / square if square > 0 else 0.0)
    spread, trend_spread = params.z * fit[5][0], params.z * fits.std(fit[3])[0] * np.sqrt(leverage)
    season = effect["weekly"] + effect["yearly"]
    yhat = trend * (1 + season)
    out = {"trend": trend, "yhat_lower": yhat - spread, "yhat_upper": yhat + spread, "trend_lower": trend - trend_spread,
           "trend_upper": trend + trend_spread, "yhat": yhat}
    for name, values in (("multiplicative_terms", season), *effect.items(), ("additive_terms", np.zeros(len(at)))):
        for suffix in ("", "_lower", "_upper"):
            out[name + suffix] = values
    return out


def blocks(bounds: np.ndarray, more: int, cells: int = 1 << 14) -> Iterator[np.ndarray]:
    """The numbers of series of like length, at most ``cells`` days with ``more`` for each, or one series."""
    size = np.diff(bounds)
    order = np.argsort(size, kind="stable")
    stop = len(order)
    while stop:
        start = max(0, stop - max(1, cells // int(size[order[stop - 1]] + more)))
        yield order[start:stop]
        stop = start


def fit_predict_many(days: np.ndarray, y: np.ndarray, bounds: np.ndarray, steps: int, params: Params) -> Solved:
    """``fit_predict`` of every series for its own days and ``steps`` more, whole blocks of series at once.

    The series of a block are the rows of matrices as wide as the longest; what is filled up counts nothing.
    """
    for block in blocks(bounds, steps):
        size = np.diff(bounds)[block]
        rows, width = len(block), int(size.max())
        used = np.arange(width) < size[:, None]
        source = np.minimum(bounds[block][:, None] + np.arange(width), bounds[block + 1][:, None] - 1)
        at, value = days[source], np.where(used, y[source], 0.0)
        start, last = at[:, :1], at[:, -1:]  # filled up with the last day
        ahead = np.hstack([at, last + np.arange(1, steps + 1)])
        u = (ahead - start) / np.maximum(1, last - start)
        own, count = u[:, :width], size[:, None]
        floor = np.maximum(1e-9, 0.01 * np.abs(value).sum(axis=1, keepdims=True) / count)
        mean_u = (own * used).sum(axis=1, keepdims=True) / count
        away = (own - mean_u) * used
        square = (away * away).sum(axis=1, keepdims=True)
        basis = {}
        if params.terms:
            distinct, place = np.unique(ahead, return_inverse=True)
            place = place.reshape(ahead.shape)
            basis = {t: fourier(distinct, t)[place] for t in params.terms}
            design = np.concatenate([b[:, :width] for b in basis.values()], axis=2) * used[:, :, None]
            turned = design.transpose(0, 2, 1)
            normal = turned @ design
            ridge = params.ridge * np.eye(normal.shape[1])
            inverse = np.linalg.inv(normal + ridge) if params.ridge > 0 else np.linalg.pinv(normal, hermitian=True)
        season = np.zeros((rows, width))
        for _ in range(TURNS if params.terms else 1):
            plain = value / np.maximum(1 + season, 0.05)
            mean = plain.sum(axis=1, keepdims=True) / count
            slope = (away * (plain - mean)).sum(axis=1, keepdims=True) / np.where(square > 0, square, 1.0)
            line = np.maximum(mean + slope * (own - mean_u), floor)
            if params.terms:
                weights = inverse @ (turned @ (value / line - 1)[:, :, None])
                season = (design @ weights)[:, :, 0]

        def std(error: np.ndarray) -> np.ndarray:
            centre = (error * used).sum(axis=1, keepdims=True) / count
            return np.sqrt((((error - centre) * used) ** 2).sum(axis=1, keepdims=True) / count)

        trend = np.maximum(mean + slope * (u - mean_u), floor)
        effect, done = {name: np.zeros(u.shape) for name in PERIODS}, 0
        for name, values in basis.items():
            effect[name] = (values @ weights[:, done: done + values.shape[2]])[:, :, 0]
            done += values.shape[2]
        leverage = 1 / count + np.where(square > 0, (u - mean_u) ** 2 / np.where(square > 0, square, 1.0), 0.0)
        spread, trend_spread = params.z * std(value - line * (1 + season)), params.z * std(value - line) * np.sqrt(leverage)
        total = effect["weekly"] + effect["yearly"]
        yhat = trend * (1 + total)
        out = {"ds": ahead, "trend": trend, "yhat_lower": yhat - spread, "yhat_upper": yhat + spread,
               "trend_lower": trend - trend_spread, "trend_upper": trend + trend_spread, "yhat": yhat}
        for name, values in (("multiplicative_terms", total), *effect.items(), ("additive_terms", np.zeros(u.shape))):
            for suffix in ("", "_lower", "_upper"):
                out[name + suffix] = values
        real = np.hstack([used, np.ones((rows, steps), bool)])
        yield np.repeat(bounds[block], size + steps), {name: values[real] for name, values in out.items()}


def rolling_errors(days: np.ndarray, y: np.ndarray, candidates: Sequence[Params], initial: int, period: int,
                   horizon: int) -> list[tuple[int, float, float]]:
    """Per candidate: predictions made, root mean square error, share inside the interval; NaN without a cut-off."""
    cuts = cut_days(days, initial, period, horizon)
    past = np.searchsorted(days, cuts, "right")
    ahead = (days > cuts[:, None]) & (days <= cuts[:, None] + horizon)
    keep = (past > 1) & ahead.any(axis=1)
    if not keep.any():
        return [(0, math.nan, math.nan)] * len(candidates)
    c, d = np.nonzero(ahead[keep])
    fits, out = Fits(days, y, past[keep]), []
    for params in candidates:
        *_, line, season, spread = fits.solve(params)
        yhat = line[c, d] * (1 + season[c, d])
        error, half = y[d] - yhat, params.z * spread[c]
        inside = (y[d] >= yhat - half) & (y[d] <= yhat + half)
        out.append((len(c), float(np.sqrt((error ** 2).mean())), float(inside.mean())))
    return out
