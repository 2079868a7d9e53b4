"""Aggregates. All combine on the map side before the shuffle."""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorloom.functions import time as ft, values as fv
from sensorloom.operators.relational import require
from sensorloom.operators.skew import skew_join

_BINS = 4096


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def distinct_count(df: DataFrame, column: str, exact: bool = True) -> DataFrame:
    count = F.count_distinct(F.col(column)) if exact else F.approx_count_distinct(column)
    return df.agg(count.alias("n"))


def count_by(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Non-null values per group."""
    return df.groupBy(*keys).agg(F.count(column).alias("n"))


def mean_by(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Mean of each column per group, missing values and NaN left out."""
    return df.groupBy(*keys).agg(*[F.avg(fv.nan_to_null(F.col(c).cast("double"))).alias(c) for c in columns])


def completeness_stats(column: str) -> list[Column]:
    rows, present = F.count(F.lit(1)), F.count(column)
    percent = F.bround(present / rows * 100, 0).cast("bigint")
    return [rows.alias("n"), present.alias("present"), percent.alias("pct")]


def completeness(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Rows, rows with a value, and the percentage rounded half to even."""
    return df.groupBy(*keys).agg(*completeness_stats(column))


def extent_stats(ts: str) -> list[Column]:
    return [F.min(ts).alias("first"), F.max(ts).alias("last")]


def extent(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """First and last time per group."""
    return df.groupBy(*keys).agg(*extent_stats(ts))


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def count_true(df: DataFrame, flag: str | Column, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(F.count_if(F.col(flag) if isinstance(flag, str) else flag).alias("n"))


def count_present(df: DataFrame, column: str) -> DataFrame:
    """Rows in which the column has a value."""
    return df.agg(F.count(column).alias("n"))


def min_rows_per(df: DataFrame, keys: Sequence[str], n: int, column: str | None = None) -> DataFrame:
    """Rows of the groups with at least ``n`` rows (or ``n`` values of ``column``)."""
    counted = F.count(F.lit(1) if column is None else F.col(column))
    large = df.groupBy(*keys).agg(counted.alias("_n")).filter(F.col("_n") >= n)
    return skew_join(df, large, keys, "left_semi")


def expected_rows(first: date, last: date, entities: int, per_day: int = 24) -> int:
    """Rows a complete hourly history holds, both days included."""
    return ((last - first).days + 1) * per_day * entities


def coverage(
    df: DataFrame, keys: Sequence[str], ts: str, per_day: int = 24, first: date | None = None, last: date | None = None,
    entities: DataFrame | None = None,
) -> DataFrame:
    """Rows per group against the rows that a full grid of the requested days, both included, would hold.

    Rows outside the days do not count; ``entities`` lists the groups that are asked for, those without a row included.
    A day that is not given is the first or last of the group itself.
    """
    day = F.to_date(ts)
    inside = df
    if first is not None:
        inside = inside.filter(day >= F.lit(first))
    if last is not None:
        inside = inside.filter(day <= F.lit(last))
    begin = F.lit(first) if first is not None else F.min(day)
    end = F.lit(last) if last is not None else F.max(day)
    found = inside.groupBy(*keys).agg(
        ((F.datediff(end, begin) + 1) * per_day).cast("bigint").alias("expected"), F.count(F.lit(1)).alias("actual")
    )
    if entities is None:
        return found
    full = expected_rows(first, last, 1, per_day) if first is not None and last is not None else 0
    out = skew_join(entities.select(*keys).distinct(), found, keys, "left")
    return out.fillna({"expected": full, "actual": 0})


def missing_hours(
    df: DataFrame, keys: Sequence[str], ts: str, first: date | None = None, last: date | None = None, entities: DataFrame | None = None
) -> DataFrame:
    """Ranges of hours without a row, per group: ``from_hour`` and ``to_hour`` (both missing) and ``hours``.

    The days ``first`` to ``last``, both included, are asked for; a day that is not given is the first or last of the group itself.
    ``entities`` lists the groups that are asked for; one without any row lacks the whole range, so both days must be
    given then. Each hour of a group is compared with the one before it, so no grid of all hours is made. Rows outside the days and
    rows without a time do not count.
    """
    if entities is not None and (first is None or last is None):
        raise ValueError("groups without rows need the days that are asked for")
    hour_us = 3_600_000_000
    day = F.to_date(ts)
    inside = require(df, ts)
    if first is not None:
        inside = inside.filter(day >= F.lit(first))
    if last is not None:
        inside = inside.filter(day <= F.lit(last))

    def number(at: Column) -> Column:
        us = ft.micros(at.cast("timestamp_ntz"))
        return ((us - F.pmod(us, F.lit(hour_us))) / hour_us).cast("bigint")

    def edge(given: date | None, own: Column, shift: int) -> Column:
        """Number of the first hour of a day, so many days on."""
        return number(F.date_add(F.lit(given) if given is not None else F.to_date(own), shift))

    hours = inside.groupBy(*keys, number(F.col(ts)).alias("_hour")).agg(F.min(ts).alias("_from"), F.max(ts).alias("_to"))
    w = Window.partitionBy(*keys)
    in_order = w.orderBy("_hour")
    before = F.coalesce(F.lag("_hour").over(in_order), edge(first, F.min("_from").over(w), 0) - 1)
    after = F.when(F.lead("_hour").over(in_order).isNull(), edge(last, F.max("_to").over(w), 1))
    gaps = hours.select(*keys, F.array(F.struct((before + 1).alias("_a"), F.col("_hour").alias("_b")), F.struct((F.col("_hour") + 1).alias("_a"), after.alias("_b"))).alias("_g"))
    ranges = gaps.select(*keys, F.inline("_g")).filter(F.col("_a") < F.col("_b"))
    if entities is not None:
        none = skew_join(entities.select(*keys).distinct(), hours, keys, "left_anti")
        ranges = ranges.unionByName(none.select(*keys, edge(first, F.lit(None), 0).alias("_a"), edge(last, F.lit(None), 1).alias("_b")))
        ranges = skew_join(ranges, entities, keys, "left_semi")

    def time(hour: Column) -> Column:
        return ft.from_micros(hour * hour_us)

    return ranges.select(*keys, time(F.col("_a")).alias("from_hour"), time(F.col("_b") - 1).alias("to_hour"), (F.col("_b") - F.col("_a")).alias("hours"))


def _values(df: DataFrame, column: str | Column) -> DataFrame:
    value = df.select((F.col(column) if isinstance(column, str) else column).cast("double").alias("x"))
    return value.select(fv.nan_to_null(F.col("x")).alias("x"))


def sketch_size(accuracy: float) -> int:
    """Size parameter k of a quantile sketch whose ranks err by at most ``accuracy`` of the rows, with a confidence of 99 %.

    The sketch of k errs by 2.296 / k ** 0.9021 (the bound published for it); it takes k from 8 to 65,535.
    """
    return min(65_535, max(8, math.ceil((2.296 / accuracy) ** (1 / 0.9021))))


def quantile_sketch(column: str | Column, accuracy: float = 0.01) -> Column:
    """Aggregate: a mergeable sketch of the finite and infinite values, filled on the map side; some k log(n / k) values whatever n."""
    return F.kll_sketch_agg_double(column, sketch_size(accuracy))


def approximate_quantile(df: DataFrame, column: str | Column, q: float | Sequence[float], accuracy: float = 0.01) -> float | list[float] | None:
    """Quantile, or several, whose rank errs by at most ``accuracy`` of the rows (99 % of the time), in one pass. None without a value.

    The result is one of the values. NaN and null do not count.
    """
    shares = [q] if isinstance(q, float | int) else list(q)
    value = _values(df, column)
    sketch = value.agg(quantile_sketch("x", accuracy).alias("s"), F.count("x").alias("n"))
    found = sketch.select("n", *[F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("s", F.lit(float(x)))).alias(f"q{i}") for i, x in enumerate(shares)]).first()
    if not found["n"]:
        return None
    out = [found[f"q{i}"] for i in range(len(shares))]
    return out[0] if isinstance(q, float | int) else out


def quantiles_by(df: DataFrame, keys: Sequence[str], column: str, shares: dict[str, float], accuracy: float = 0.01) -> DataFrame:
    """``{output name: q}`` quantiles per group, each with the error bound of :func:`approximate_quantile`; one sketch a group serves all."""
    value = df.select(*keys, fv.nan_to_null(F.col(column).cast("double")).alias("_x"))
    made = value.filter(F.col("_x").isNotNull()).groupBy(*keys).agg(quantile_sketch("_x", accuracy).alias("_s"))
    return made.select(*keys, *[F.kll_sketch_get_quantile_double("_s", F.lit(float(x))).alias(name) for name, x in shares.items()])


#: Rank error of the sketch from which an exact quantile takes its first bracket.
_BRACKET = 0.004


def exact_quantile(df: DataFrame, column: str | Column, q: float) -> float | None:
    """Exact quantile with linear interpolation between the two neighbouring values; NaN and null do not count.

    The first pass counts the values and sketches them. The sketch brackets the wanted ranks by about one per cent of the rows. The
    second counts what lies below the bracket and bins what lies in it; bins over 4096 keep the range that holds the rank, and
    further passes narrow that, if its two neighbours are not known yet. A bracket that misses (one time in a hundred) is
    widened to the end. Infinite values are counted at the ends. Hot values end the search early.
    """
    value = _values(df, column)
    infinite = F.lit(float("inf"))
    finite = F.when(F.abs("x") < infinite, F.col("x"))
    summary = value.agg(
        F.count("x").alias("n"), F.count_if(F.col("x") == -infinite).alias("under"), F.count_if(F.col("x") == infinite).alias("over"),
        F.min(finite).alias("low"), F.max(finite).alias("high"), quantile_sketch(finite, _BRACKET).alias("s"),
    )
    n, under, over, low, high, sketch = summary.first()
    if not n:
        return None
    rank = q * (n - 1)
    lower, upper = math.floor(rank), math.ceil(rank)

    def end(r: int) -> float | None:
        return -math.inf if r < under else math.inf if r >= n - over else None

    inner = sorted({r - under for r in (lower, upper) if end(r) is None})
    inside = {}
    if inner:
        share = (rank - under) / (n - under - over)
        edges = [F.kll_sketch_get_quantile_double(F.lit(bytes(sketch)), F.lit(min(max(share + shift, 0.0), 1.0))) for shift in (-_BRACKET, _BRACKET)]
        left, right = df.sparkSession.range(1).select(*edges).first()
        inside = _ranked(value.filter(F.abs("x") < infinite), low, left, right, high, inner)
    a, b = (inside[r - under] if end(r) is None else end(r) for r in (lower, upper))
    return a if lower == upper or a == b else a + (b - a) * (rank - lower)


def _ranked(value: DataFrame, low: float, left: float, right: float, high: float, ranks: list[int]) -> dict[int, float]:
    """Values at one rank or two neighbouring ranks among finite values between ``low`` and ``high``, looked for in [left, right] first."""
    below, narrowing = 0, True
    while low < high:
        half, width = F.col("x") * 0.5 - left * 0.5, right * 0.5 - left * 0.5  # halves, so that the width is finite
        if narrowing and (width > 0 or left == right):
            within = F.least(F.floor(half / width * _BINS), F.lit(_BINS - 1)) if width > 0 else F.lit(0)
            spot = F.when(F.col("x") < left, -1).when(F.col("x") > right, _BINS).otherwise(within)
        else:
            spot = F.col("x")
        bins = (
            value.filter(F.col("x").between(low, high))
            .groupBy(spot.alias("bin"))
            .agg(F.count("x").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
            .collect()
        )
        homes = {}
        for b in sorted(bins, key=lambda b: b["low"]):
            homes.update({r: (below, b) for r in ranks if below <= r < below + b["n"]})
            below += b["n"]
        below, home = homes[ranks[0]]
        if homes[ranks[-1]][1] != home:  # last value of one bin, first value of the next
            return {ranks[0]: home["high"], ranks[-1]: homes[ranks[-1]][1]["low"]}
        narrowing = (home["low"], home["high"]) != (low, high)
        low = left = home["low"]
        high = right = home["high"]
    return dict.fromkeys(ranks, low)


def time_quantile(df: DataFrame, ts: str, q: float, accuracy: float | None = None) -> float | None:
    """Quantile of a timestamp in epoch microseconds, over all rows of all groups: exact, or with a rank error of at most ``accuracy``."""
    at = ft.micros(F.col(ts))
    return exact_quantile(df, at, q) if accuracy is None else approximate_quantile(df, at, q, accuracy)
