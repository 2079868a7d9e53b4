"""Window operators over keyed, ordered rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from sensorloom.functions import time as ft, values as fv
from sensorloom.operators.skew import over_clock, over_series, skew_join, with_position


def lag_columns(df: DataFrame, w: WindowSpec, value: str, lags: dict[str, int]) -> DataFrame:
    return df.withColumns({name: F.lag(value, n).over(w) for name, n in lags.items()})


def trailing_columns(df: DataFrame, w: WindowSpec, value: str, n: int, out: dict[str, str]) -> DataFrame:
    """Mean or sample deviation of the previous ``n`` rows, null unless all ``n`` have a value."""
    stats = {"mean": F.avg, "std": F.stddev_samp}
    frame = w.rowsBetween(-n, -1)
    full = F.count(value).over(frame) == n
    return df.withColumns({name: F.when(full, stats[kind](value).over(frame)) for name, kind in out.items()})


def add_lags(
    df: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str], value: str, lags: dict[str, int], **split
) -> DataFrame:
    """``{output name: steps}`` lags by row position within a key."""
    return over_series(
        df, keys, [ts, *tiebreak], max(lags.values()), lambda d, w: lag_columns(d, w, value, lags), **split
    )


def add_trailing(
    df: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str], value: str, n: int, out: dict[str, str], **split
) -> DataFrame:
    """``{output name: 'mean' | 'std'}`` over the previous ``n`` rows of a key, the current row left out."""
    return over_series(
        df, keys, [ts, *tiebreak], n, lambda d, w: trailing_columns(d, w, value, n, out), **split
    )


def clock_tick(ts: str, step_seconds: int = 3600) -> Column:
    """Number of the step of a clock that a time lies in."""
    us, step = ft.micros(F.col(ts)), F.lit(step_seconds * 1_000_000)
    return ((us - F.pmod(us, step)) / step).cast("bigint")


def add_clock_lags(
    df: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str], value: str, lags: dict[str, int], step_seconds: int = 3600, **split
) -> DataFrame:
    """``{output name: steps}`` lags by the clock: the last value of the step (an hour) that lies so many steps before the row's own.

    A step without rows gives null, where :func:`add_lags` would take the row before the gap. Rows without a time have no
    lags. The last row of a step is the last by time, then by ``tiebreak``; its value counts even if it is null.
    """
    last = F.max_by(value, F.struct(ts, *tiebreak))

    def add(d: DataFrame, w: WindowSpec) -> DataFrame:
        timed = F.col("_tick").isNotNull()
        return d.withColumns({name: F.when(timed, last.over(w.rangeBetween(-n, -n))) for name, n in lags.items()})

    return over_clock(df, keys, clock_tick(ts, step_seconds), max(lags.values()), add, **split)


def add_clock_trailing(
    df: DataFrame, keys: Sequence[str], ts: str, value: str, n: int, out: dict[str, str], step_seconds: int = 3600, **split
) -> DataFrame:
    """``{output name: 'mean' | 'std'}`` over the rows of the ``n`` steps before the row's own, null unless each of them has a value."""
    stats = {"mean": F.avg, "std": F.stddev_samp}

    def add(d: DataFrame, w: WindowSpec) -> DataFrame:
        frame = w.rangeBetween(-n, -1)
        seen = F.size(F.collect_set(F.when(F.col(value).isNotNull(), F.col("_tick"))).over(frame))
        full = F.col("_tick").isNotNull() & (seen == n)
        return d.withColumns({name: F.when(full, stats[kind](value).over(frame)) for name, kind in out.items()})

    return over_clock(df, keys, clock_tick(ts, step_seconds), n, add, **split)


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str]) -> DataFrame:
    """The latest row of each key; a row without a time counts as the latest.

    ``row_number() = 1`` is planned with a group limit before the shuffle, so a task sends one row per key.
    """
    order = [F.col(ts).desc_nulls_first(), *[F.col(c).desc_nulls_last() for c in tiebreak]]
    return _first(df, keys, order)


def last_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the last in feed order."""
    return _first(df, keys, [F.col(c).desc_nulls_last() for c in order])


def _first(df: DataFrame, keys: Sequence[str], order) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1).drop("_rank")


def sequential_id(df: DataFrame, order: Sequence[str], name: str = "id") -> DataFrame:
    """Number all rows from 1 in the given total order."""
    placed = with_position(df, order, "_pos")
    return placed.select((F.col("_pos") + 1).alias(name), *df.columns)


def mark_history(
    df: DataFrame, history: DataFrame, series: Sequence[str], ts: str, name: str = "type",
    labels: tuple[str, str] = ("historique", "prediction"),
) -> DataFrame:
    """Label rows up to the last history time of their series, and the rows after it."""
    ends = history.groupBy(*series).agg(F.max(ts).alias("_end"))
    joined = skew_join(df, ends, series, "inner")
    return joined.withColumn(name, fv.label_if(F.col(ts) <= F.col("_end"), *labels)).drop("_end")
