"""Time-series feature table and temporal split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, WindowSpec, functions as F

from sensorloom.functions import time as ft
from sensorloom.operators.aggregates import time_quantile
from sensorloom.operators.relational import drop_incomplete, require
from sensorloom.operators.skew import over_series
from sensorloom.operators.windows import lag_columns, trailing_columns

LAG_STEPS = (1, 2, 3, 6, 12, 24)
TRAILING_ROWS = 24
TIME_FEATURES = ["hour_sin", "hour_cos", "month_sin", "month_cos", "weekday", "day_of_year"]


def time_features(df: DataFrame, ts: str) -> DataFrame:
    """Calendar columns and the cyclic encodings of hour and month."""
    out = df.withColumns(
        ft.calendar(
            F.col(ts), {"hour": "hour", "weekday": "weekday", "month": "month", "day_of_year": "day_of_year"}
        )
    )
    (hour_sin, hour_cos), (month_sin, month_cos) = ft.cyclic(F.col("hour"), 24), ft.cyclic(F.col("month"), 12)
    return out.withColumns(
        {"hour_sin": hour_sin, "hour_cos": hour_cos, "month_sin": month_sin, "month_cos": month_cos}
    )


def feature_names(key: str, value: str, covariates: Sequence[str], lags=LAG_STEPS, window=TRAILING_ROWS) -> list[str]:
    return [
        *TIME_FEATURES,
        key,
        *[f"{value}_lag_{n}" for n in lags],
        f"{value}_mean_{window}",
        f"{value}_std_{window}",
        *covariates,
    ]


def ts_features(
    df: DataFrame,
    key: str,
    ts: str,
    value: str,
    tiebreak: Sequence[str] = (),
    covariates: Sequence[str] = (),
    lags: Sequence[int] = LAG_STEPS,
    window: int = TRAILING_ROWS,
    complete_first: Sequence[str] = (),
    **split,
) -> DataFrame:
    """Feature table of a regular series per key: calendar, cyclic, lag and trailing-window features.

    Lags count rows, not hours. Rows with a missing feature or target are dropped at the end; rows missing
    one of ``complete_first`` are dropped before the lags are taken. One shuffle by key serves all windows.
    """
    base = df.select(*dict.fromkeys([key, ts, *tiebreak, value, *covariates]))
    if complete_first:
        base = require(base, *complete_first)
    names = {f"{value}_lag_{n}": n for n in lags}

    def add(d: DataFrame, w: WindowSpec) -> DataFrame:
        d = lag_columns(d, w, value, names)
        return trailing_columns(
            d, w, value, window, {f"{value}_mean_{window}": "mean", f"{value}_std_{window}": "std"}
        )

    framed = over_series(base, [key], [ts, *tiebreak], max(*lags, window), add, **split)
    return drop_incomplete(
        time_features(framed, ts), [*feature_names(key, value, covariates, lags, window), value]
    )


def temporal_split(df: DataFrame, ts: str, q: float = 0.8, accuracy: float | None = None) -> tuple[DataFrame, DataFrame, float]:
    """Rows up to the time quantile, rows after it, and the quantile in epoch microseconds.

    The quantile is a literal in both filters, so they reach the scan of a stored feature table. It is exact, or, with
    ``accuracy``, found in one pass with a rank error of at most that share of the rows.
    """
    cut = time_quantile(df, ts, q, accuracy)
    if cut is None:
        return df, df.limit(0), None
    # whole microseconds are compared, so the fraction of the cut decides nothing
    edge = ft.from_micros(F.floor(F.lit(cut)))
    return df.filter(F.col(ts) <= edge), df.filter(F.col(ts) > edge), cut
