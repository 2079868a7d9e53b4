"""Data-quality checks: each returns the failing rows."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; null is not checked."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") > 1)


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def _null_counts(columns: list[str]) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)]


def _observed(seen: Observation, columns: list[str]) -> dict[str, int]:
    try:
        found = seen.get
    except Py4JJavaError:  # nothing is observed of an input that is empty by its plan
        found = {}
    return {c: found.get(f"n{i}") or 0 for i, c in enumerate(columns)}


def _repeated(df: DataFrame, columns: list[str]) -> DataFrame:
    """``at`` (number of the column) and ``failures``: values that occur more than once, of all columns in one shuffle."""
    keys = [f"k{i}" for i in range(len(columns))]
    none = {c: F.lit(None).cast(dict(df.dtypes)[c]) for c in columns}
    each = [
        F.struct(F.lit(i).alias("at"), *[(F.col(c) if i == j else none[c]).alias(k) for j, (k, c) in enumerate(zip(keys, columns))])
        for i, c in enumerate(columns)
    ]
    values = df.select(F.inline(F.array(*each))).filter(F.coalesce(*[F.when(F.col(k).isNotNull(), 1) for k in keys]).isNotNull())
    counts = values.groupBy("at", *keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("at").agg(F.count_if(F.col("n") > 1).alias("failures"))


def _report(spark: SparkSession, checks: list[tuple[str, str]], nulls: dict[str, int], repeated: dict[str, int]) -> DataFrame:
    rows = [(kind, c, (nulls if kind == "not_null" else repeated)[c]) for kind, c in checks]
    found = spark.createDataFrame(rows, 'check string, `column` string, failures bigint')
    return found.withColumn("passed", F.col("failures") == 0)


def _sorted_out(checks: list[tuple[str, str]]) -> tuple[list[str], list[str]]:
    unknown = {kind for kind, _ in checks} - {"not_null", "unique"}
    if unknown:
        raise ValueError(f"unknown checks {sorted(unknown)}")
    return [c for kind, c in checks if kind == "not_null"], [c for kind, c in checks if kind == "unique"]


def run_checks(df: DataFrame, checks: list[tuple[str, str]]) -> DataFrame:
    """``[(check, column)]`` to one row each: check, column, failing rows (``not_null``) or values (``unique``), passed.

    The input is read once: null counts are observed on the rows as they pass, and all ``unique`` columns share one shuffle.
    """
    present, unique = _sorted_out(checks)
    seen = Observation()
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows"), *_null_counts(present))
    if unique:
        repeated = {r["at"]: r["failures"] for r in _repeated(watched, unique).collect()}  # a row per column
    else:
        watched.write.format("noop").mode("overwrite").save()
        repeated = {}
    nulls = _observed(seen, present)
    return _report(df.sparkSession, checks, nulls, {c: repeated.get(i, 0) for i, c in enumerate(unique)})


def write_checked(df: DataFrame, path: str, checks: list[tuple[str, str]], mode: str = "overwrite") -> DataFrame:
    """Write a Parquet table and report its checks: nulls are counted by the write itself, and only the ``unique`` columns are read again."""
    present, unique = _sorted_out(checks)
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *_null_counts(present)).write.mode(mode).parquet(path)
    nulls = _observed(seen, present)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    repeated = {r["at"]: r["failures"] for r in _repeated(written.select(*unique), unique).collect()} if unique else {}
    return _report(df.sparkSession, checks, nulls, {c: repeated.get(i, 0) for i, c in enumerate(unique)})
