"""Per-series forecasts: trend, daily and weekly pattern, 80 % band.

Neither method holds a series in one task. Both reduce it to a bounded summary:
:func:`seasonal_forecast` to at most 24 x 7 cells, :func:`additive_forecast` to one normal-equation matrix.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorloom.functions import time as ft, values as fv
from sensorloom.operators.joins import join_dim
from sensorloom.operators.relational import drop_incomplete, stack
from sensorloom.session import settle

# fixed values: horizon, band, and the smallest series that is forecast
HORIZON = 24
BAND = 1.2816  # half-width of an 80 % normal band in standard deviations
MIN_POINTS = 5
HISTORY, FUTURE = "historique", "prediction"

_HOUR_US = 3_600_000_000


def extend_time(df: DataFrame, series: Sequence[str], ts: str, n: int = HORIZON, step: str = "1 hour") -> DataFrame:
    """``n`` steps after the last time of each series."""
    last = df.groupBy(*series).agg(F.max(ts).alias("_last"))
    first = F.expr(f"_last + interval {step}")
    stop = F.expr(f"_last + {n} * interval {step}")
    return last.select(*series, F.explode(F.sequence(first, stop, F.expr(f"interval {step}"))).alias(ts))


def _hours(ts: str) -> Column:
    """Hours since the start of 2020."""
    return (ft.micros(F.col(ts)) - F.lit(1_577_836_800_000_000)) / F.lit(float(_HOUR_US))


def seasonal_fit(
    df: DataFrame, series: Sequence[str], ts: str, value: str, min_points: int = MIN_POINTS
) -> DataFrame:
    """Linear trend plus mean residual by hour, then by weekday: one row per series, hour and weekday.

    The rows are reduced once, to counts, means, variances and the covariance per cell; trend, effects and
    residual spread follow exactly from those with windows of at most 168 rows.
    """
    y, t = F.col(value), F.col("_t")
    cells = (
        df.select(*series, value, ts, _hours(ts).alias("_t"))
        .groupBy(*series, F.hour(ts).alias("_hour"), ft.weekday0(F.col(ts)).alias("_weekday"))
        .agg(
            F.count(value).alias("n"), F.avg(y).alias("y"), F.avg(t).alias("t"),
            F.var_pop(y).alias("vy"), F.var_pop(t).alias("vt"), F.covar_pop(t, y).alias("c"), F.max(ts).alias("_end"),
        )
    )
    every = Window.partitionBy(*series)

    def mean(x: Column, *by: str) -> Column:
        w = Window.partitionBy(*series, *by)
        return F.sum(F.col("n") * x).over(w) / F.sum("n").over(w)

    total = F.sum("n").over(every)
    centred = cells.withColumns({"ty": mean(F.col("y")), "tt": mean(F.col("t")), "total": total})
    centred = centred.filter(F.col("total") >= min_points)
    dt, dy = F.col("t") - F.col("tt"), F.col("y") - F.col("ty")
    var_t = F.sum(F.col("n") * (F.col("vt") + dt * dt)).over(every)
    cov = F.sum(F.col("n") * (F.col("c") + dt * dy)).over(every)
    sloped = centred.withColumn("slope", F.when(var_t > 0, cov / var_t).otherwise(F.lit(0.0)))
    hourly = sloped.withColumn("r", dy - F.col("slope") * dt)
    hourly = hourly.withColumn("by_hour", mean(F.col("r"), "_hour")).withColumn("r", F.col("r") - F.col("by_hour"))
    both = hourly.withColumn("by_weekday", mean(F.col("r"), "_weekday")).withColumn("r", F.col("r") - F.col("by_weekday"))
    slope = F.col("slope")
    inner = F.col("vy") + slope * slope * F.col("vt") - 2 * slope * F.col("c")
    square = F.sum(F.col("n") * (inner + F.col("r") * F.col("r"))).over(every)
    centre = F.sum(F.col("n") * F.col("r")).over(every)
    spread = F.greatest(square - centre * centre / F.col("total"), F.lit(0.0))
    sigma = F.when(F.col("total") > 1, F.sqrt(spread / (F.col("total") - 1)))
    return both.withColumn("sigma", sigma).select(
        *series, "_hour", "_weekday", F.col("ty").alias("level"), F.col("tt").alias("centre"),
        "slope", "by_hour", "by_weekday", "sigma", "_end",
    )


def seasonal_forecast(
    df: DataFrame, series: Sequence[str], ts: str, value: str,
    horizon: int = HORIZON, min_points: int = MIN_POINTS, step: str = "1 hour",
) -> DataFrame:
    """Fitted history and ``horizon`` future steps with ``yhat``, ``yhat_lower``, ``yhat_upper``, ``type``.

    Series with fewer than ``min_points`` values are left out; an hour or weekday never seen counts as 0.
    """
    points = drop_incomplete(df.select(*series, ts, value), [ts, value])
    fit = settle(seasonal_fit(points, series, ts, value, min_points))
    keys = [*series, "_hour", "_weekday"]

    def placed(rows: DataFrame) -> DataFrame:
        return rows.withColumns({"_hour": F.hour(ts), "_weekday": ft.weekday0(F.col(ts)), "_t": _hours(ts)})

    history = join_dim(placed(points.select(*series, ts).distinct()), fit, keys)
    trend = fit.groupBy(*series).agg(*[F.first(c).alias(c) for c in ("level", "centre", "slope", "sigma")])
    hours = fit.groupBy(*series, "_hour").agg(F.first("by_hour").alias("by_hour"))
    days = fit.groupBy(*series, "_weekday").agg(F.first("by_weekday").alias("by_weekday"))
    future = placed(extend_time(fit.withColumnRenamed("_end", ts), series, ts, horizon, step))
    future = join_dim(future, trend, series)
    future = join_dim(join_dim(future, hours, [*series, "_hour"], "left"), days, [*series, "_weekday"], "left")
    columns = [*series, ts, "_t", "level", "centre", "slope", "by_hour", "by_weekday", "sigma", "type"]
    rows = stack(
        history.withColumn("type", F.lit(HISTORY)).select(*columns),
        future.withColumn("type", F.lit(FUTURE)).select(*columns),
    )
    yhat = (
        F.col("level") + F.col("slope") * (F.col("_t") - F.col("centre"))
        + fv.zero_if_missing(F.col("by_hour")) + fv.zero_if_missing(F.col("by_weekday"))
    )
    return _banded(rows, [*series, ts], yhat, F.col("sigma"))


def _banded(rows: DataFrame, ids: Sequence[str], yhat: Column, sigma: Column) -> DataFrame:
    half = F.lit(BAND) * sigma
    return rows.select(
        *ids, yhat.alias("yhat"), (yhat - half).alias("yhat_lower"), (yhat + half).alias("yhat_upper"), "type"
    )


def published(forecast: DataFrame) -> DataFrame:
    """Forecast values rounded to 2 digits and never below 0."""
    names = {"yhat": "valeur_pred", "yhat_lower": "valeur_min", "yhat_upper": "valeur_max"}
    rounded = fv.round_columns(forecast.withColumnsRenamed(names), dict.fromkeys(names.values(), 2))
    return rounded.withColumns({c: fv.clamp_min(F.col(c), 0.0) for c in names.values()})


# --- additive model: piecewise-linear trend, Fourier terms (Taylor and Letham 2018) ---

# fixed values of the model the forecasts follow
CHANGEPOINTS = 25
CHANGEPOINT_RANGE = 0.8
CHANGEPOINT_SCALE = 0.05
SEASONAL_SCALE = 10.0
TREND_SCALE = 5.0
DAILY_ORDER = 4
WEEKLY_ORDER = 3

PART_ROWS = 200_000  # rows of one series that go to one task

_ROUNDS = 30


def _basis(ts: Column, first: Column, last: Column) -> list[Column]:
    """Model terms at a time: level, slope, slope changes, daily and weekly waves."""
    us = ft.micros(ts).cast("double")
    begin, end = ft.micros(first).cast("double"), ft.micros(last).cast("double")
    tau = F.when(end > begin, (us - begin) / (end - begin)).otherwise(F.lit(0.0))
    terms = [F.lit(1.0), tau]
    for i in range(1, CHANGEPOINTS + 1):
        terms.append(F.greatest(tau - F.lit(CHANGEPOINT_RANGE * i / CHANGEPOINTS), F.lit(0.0)))
    for hours, order in ((24, DAILY_ORDER), (168, WEEKLY_ORDER)):
        for k in range(1, order + 1):
            terms += ft.cyclic(us / F.lit(float(_HOUR_US)) * k, hours)
    return terms


def _prior() -> np.ndarray:
    waves = 2 * (DAILY_ORDER + WEEKLY_ORDER)
    return np.array([TREND_SCALE] * 2 + [0.0] * CHANGEPOINTS + [SEASONAL_SCALE] * waves)


def _solve(gram: np.ndarray) -> tuple[np.ndarray, float] | None:
    """Coefficients and residual deviation from ``[X y]' [X y]``.

    Normal priors on level, slope and waves, a Laplace prior on the slope changes by reweighting. None for a series
    that cannot be solved: infinite values, or a singular system.
    """
    if not np.isfinite(gram).all():
        return None
    xx, xy, yy, n = gram[:-1, :-1], gram[:-1, -1], gram[-1, -1], gram[0, 0]
    scale = _prior()
    bends = scale == 0.0
    beta, sigma2 = np.zeros(len(xy)), max(yy / n, 1e-12)
    if yy - xy[0] ** 2 / n <= 1e-12 * max(yy, 1e-300):  # a constant series has nothing to fit
        beta[0] = xy[0] / n
        return beta, 0.0
    for _ in range(_ROUNDS):
        weight = np.zeros(len(beta))
        weight[~bends] = 1.0 / scale[~bends] ** 2
        weight[bends] = 1.0 / (CHANGEPOINT_SCALE * (np.abs(beta[bends]) + 1e-4))
        try:
            beta = np.linalg.solve(xx + np.diag(weight) * sigma2, xy)
        except np.linalg.LinAlgError:
            return None
        if not np.isfinite(beta).all():
            return None
        sigma2 = max((yy - 2 * beta @ xy + beta @ xx @ beta) / n, 1e-12)
    return beta, float(np.sqrt(sigma2))


def _trend_variance(beta: Column, ahead: Column) -> Column:
    """Variance of the trend ``ahead`` histories after its end, from slope changes still to come.

    They are taken to come as in the history, at random times and CHANGEPOINTS to a history, with sizes spread as the fitted ones: a Laplace
    law of mean size s, whose square has the mean 2 s^2. A change at u moves the trend at h by its size times h - u, which adds up
    to CHANGEPOINTS * 2 s^2 * h^3 / 3.
    """
    bends = F.slice(beta, 3, CHANGEPOINTS)
    size = F.aggregate(bends, F.lit(0.0), lambda total, x: total + F.abs(x)) / CHANGEPOINTS
    return CHANGEPOINTS * 2.0 * size * size * ahead * ahead * ahead / 3.0


def additive_fit(
    df: DataFrame, series: Sequence[str], ts: str, value: str, min_points: int = MIN_POINTS
) -> DataFrame:
    """One row per series: first and last time, value scale, coefficients, residual deviation.

    The rows of a series come to one task, sorted, which adds up ``[X y]' [X y]`` batch by batch and solves it there, so that it holds one
    batch and one matrix. A large series goes to several tasks in parts of bounded size; Spark sums their matrices entry by entry
    and only the sums are solved. A series that cannot be solved has null coefficients.
    """
    span = (
        df.groupBy(*series)
        .agg(
            F.min(ts).alias("_first"), F.max(ts).alias("_last"),
            F.max(F.abs(value)).alias("_scale"), F.count(value).alias("_n"),
        )
        .filter(F.col("_n") >= min_points)
        .withColumn("_scale", F.when(F.col("_scale") > 0, F.col("_scale")).otherwise(F.lit(1.0)))
    )
    span = settle(span)
    rows = join_dim(df, span, series)
    # copies of a row in different input partitions go to different parts
    parts = F.ceil(F.col("_n") / F.lit(PART_ROWS))
    rows = rows.withColumn("_part", F.pmod(F.xxhash64(ts, value, F.spark_partition_id()), parts)).withColumn("_whole", parts <= 1)
    rows = rows.repartition(*series, "_part").sortWithinPartitions(*series)
    terms = _basis(F.col(ts), F.col("_first"), F.col("_last"))
    p = len(terms) + 1
    keys = list(series)
    key_schema = ", ".join(f"`{c}` {t}" for c, t in df.select(*keys).dtypes)
    upper = np.triu_indices(p)

    def add_up(batches):
        sums: dict[tuple, list] = {}
        for pdf in batches:
            last = None
            for key, part in pdf.groupby(keys, sort=False, dropna=False):
                x = np.stack(part["_x"].to_numpy())
                before = sums.get(key)
                sums[key] = [(before[0] if before else 0.0) + x.T @ x, bool(part["_whole"].iloc[0])]
                last = key
            done = [k for k in sums if k != last]  # the last may go on in the next batch
            if done:
                yield finished({k: sums.pop(k) for k in done})
        if sums:
            yield finished(sums)

    def finished(sums):
        out = pd.DataFrame(list(sums), columns=keys)
        solved = [_solve(m) or (None, None) if whole else (None, None) for m, whole in sums.values()]
        out["beta"] = pd.Series([b for b, _ in solved], dtype=object)
        out["sigma"] = pd.Series([s for _, s in solved], dtype=float).astype(object).where(lambda s: s.notna(), None)
        out["_gram"] = pd.Series([None if whole else m[upper] for m, whole in sums.values()], dtype=object)
        return out

    design = rows.select(*keys, "_whole", F.array(*terms, F.col(value) / F.col("_scale")).alias("_x"))
    found = settle(design.mapInPandas(add_up, f"{key_schema}, beta array<double>, sigma double, _gram array<double>"))
    entries = found.filter(F.col("_gram").isNotNull()).select(*keys, F.posexplode("_gram").alias("_at", "_v"))
    summed = entries.groupBy(*keys, "_at").agg(F.sum("_v").alias("_v"))
    # the collected list has p * (p + 1) / 2 entries whatever the size of the series
    grams = summed.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_at", "_v")))["_v"].alias("_gram"))

    @F.pandas_udf("beta array<double>, sigma double")
    def solved(grams: pd.Series) -> pd.DataFrame:
        results = []
        for entries in grams:
            m = np.zeros((p, p))
            m[upper] = entries
            results.append(_solve(m + np.triu(m, 1).T) or (None, None))
        return pd.DataFrame({"beta": [b for b, _ in results], "sigma": pd.Series([s for _, s in results], dtype=float)})

    large = grams.select(*keys, solved("_gram").alias("_fit")).select(*keys, "_fit.beta", "_fit.sigma")
    fit = stack(found.filter(F.col("_gram").isNull()).drop("_gram"), large)
    return join_dim(span.drop("_n"), fit, keys)


def additive_forecast(
    df: DataFrame, series: Sequence[str], ts: str, value: str,
    horizon: int = HORIZON, min_points: int = MIN_POINTS, step: str = "1 hour",
) -> DataFrame:
    """As :func:`seasonal_forecast`, with slope changes and Fourier terms fitted together.

    The band of future steps also holds the slope changes that may come, so it widens with the distance from the history.
    """
    points = drop_incomplete(df.select(*series, ts, value), [ts, value])
    # a series that cannot be solved is skipped, with its history
    fit = settle(additive_fit(points, series, ts, value, min_points)).filter(F.col("beta").isNotNull())
    ends = fit.select(*series, F.col("_last").alias(ts))
    rows = stack(
        points.select(*series, ts).distinct().withColumn("type", F.lit(HISTORY)),
        extend_time(ends, series, ts, horizon, step).withColumn("type", F.lit(FUTURE)),
    )
    placed = join_dim(rows, fit, series)
    terms = _basis(F.col(ts), F.col("_first"), F.col("_last"))
    weighted = [F.col("beta")[i] * term for i, term in enumerate(terms)]
    yhat = reduce(lambda a, b: a + b, weighted) * F.col("_scale")
    ahead = F.greatest(terms[1] - 1.0, F.lit(0.0))  # in lengths of the history
    sigma = F.sqrt(F.col("sigma") * F.col("sigma") + _trend_variance(F.col("beta"), ahead))
    return _banded(placed, [*series, ts], yhat, sigma * F.col("_scale"))
