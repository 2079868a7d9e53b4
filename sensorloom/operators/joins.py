"""Joins: time buckets, dimensions, latest row per key, lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from sensorloom.functions import time as ft
from sensorloom.operators.relational import require
from sensorloom.operators.skew import SHARE_ROWS, Hot, copy, deal, skew_join
from sensorloom.operators.windows import last_wins, latest_per_key


def bucket_left_join(
    left: DataFrame,
    feeds: dict[str, DataFrame],
    keys: Sequence[str],
    left_ts: str,
    feed_ts: str,
    unit: str = "hour",
    hot_left: Hot = None,
    hot_right: dict[str, Hot] | None = None,
    share_rows: int = SHARE_ROWS,
    latest: Sequence[str] | None = None,
) -> DataFrame:
    """Left join feeds on key and time bucket. Several matches in a bucket multiply the rows.

    With ``latest``, columns of every feed that break ties, only the latest row of each key and bucket of a feed is joined, so the
    rows of ``left`` stay as many. The cut happens on the shuffle that the join needs anyway, after a first one in each task.

    ``feeds`` maps a prefix to a frame holding the keys and ``feed_ts``; its other columns come back as
    ``prefix_column``. All feeds join on the same columns, so ``left`` is shuffled once; hot buckets of
    ``left``, if given, are dealt to shares once, for all feeds. Hot buckets of a feed are looked for.
    """
    on = [*keys, "_bucket"]
    out = left.withColumn("_bucket", ft.bucket(F.col(left_ts), unit))
    hot = None if isinstance(hot_left, dict) and not hot_left else hot_left
    joined_on = on if hot is None else [*on, "_share"]
    if hot is not None:
        out = deal(out, on, hot, "_share", share_rows)
    for prefix, feed in feeds.items():
        values = [F.col(c).alias(f"{prefix}_{c}") for c in feed.columns if c not in (*keys, feed_ts)]
        bucketed = require(feed.withColumn("_bucket", ft.bucket(F.col(feed_ts), unit)), *on)
        if latest is not None:
            bucketed = last_wins(bucketed, on, [feed_ts, *latest])
        right = bucketed.select(*on, *values)
        if hot is not None:
            right = copy(right, on, hot, "_share", share_rows)
        found = {} if latest is not None else None if hot_right is None else hot_right.get(prefix, {})
        out = skew_join(out, right, joined_on, "left", {}, found, share_rows)
    return out.drop("_bucket", "_share")


def join_dim(df: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join to a dimension with one row per key.

    Spark broadcasts it when it is within the broadcast threshold; else it splits the partitions of hot keys of ``df``.
    """
    on = [on] if isinstance(on, str) else on
    return skew_join(df, dim, on, how)


def left_join_latest(
    dim: DataFrame, facts: DataFrame, key: str, ts: str, tiebreak: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Each dimension row with the columns of its latest fact row; no fact row gives nulls.

    The facts are cut to one row per key before the join, so the join moves no duplicates.
    """
    needed = list(dict.fromkeys([key, ts, *tiebreak, *columns]))
    newest = latest_per_key(facts.select(*needed), [key], ts, tiebreak)
    return join_dim(dim, newest.select(key, *columns), key, "left")


def lookup(df: DataFrame, dim: DataFrame, on: str | Sequence[str], defaults: dict) -> DataFrame:
    """Left join to a dimension; missing values take the defaults."""
    out = join_dim(df, dim, on, "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def keep_matched(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``other``."""
    return skew_join(df, other, keys, "left_semi")


def to_long(df: DataFrame, ids: Sequence[str], measures: Sequence[str], name="measure", value="y") -> DataFrame:
    """One row per entity and measure."""
    return df.unpivot(list(ids), list(measures), name, value)
