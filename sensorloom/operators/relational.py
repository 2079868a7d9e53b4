"""Projection, filters, renames, unions, sorts and top-k."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def project(df: DataFrame, out: dict[str, str | Column]) -> DataFrame:
    """Select ``{output name: column}``; a column may appear under several names."""
    return df.select(*[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in out.items()])


def where_true(df: DataFrame, flag: str | Column) -> DataFrame:
    """Rows where the flag is true; false and null are left out."""
    return df.filter(F.col(flag) if isinstance(flag, str) else flag)


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where no listed column is null."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))


def where_eq(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) == F.lit(value))


def drop_incomplete(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Rows with every listed column present; NaN counts as missing."""
    return df.dropna(how="any", subset=list(subset))


def drop_if_present(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)


def rename_all(df: DataFrame, *names: str) -> DataFrame:
    """Rename all columns by position."""
    return df.toDF(*names)


def min_rows(df: DataFrame, n: int) -> bool:
    """True when the frame has at least ``n`` rows; reads no more than it must."""
    return df.limit(n).count() >= n


def stack(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, columns matched by name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def sort(df: DataFrame, *columns: str | Column) -> DataFrame:
    return df.orderBy(*columns)


def top_groups(df: DataFrame, key: str, column: str, k: int) -> DataFrame:
    """The ``k`` groups with the most non-null values; ties go to the smaller key."""
    counts = df.groupBy(key).agg(F.count(column).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(key)).limit(k)
