"""Standardisation and share thresholds. Both need one aggregate row, which goes into the plan as literals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from sensorloom.operators.aggregates import exact_quantile


def standardise(df: DataFrame, columns: Sequence[str], suffix: str = "") -> DataFrame:
    """Mean 0 and population deviation 1; a constant column is only centred."""
    stats = df.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in columns], *[F.stddev_pop(c).alias(f"{c}_sd") for c in columns]
    ).first()
    return df.withColumns(
        {
            f"{c}{suffix}": (F.col(c) - F.lit(stats[f"{c}_mean"]).cast("double"))
            / F.lit(stats[f"{c}_sd"] or 1.0)
            for c in columns
        }
    )


def flag_top_share(df: DataFrame, score: str, share: float, flag: str = "flag") -> DataFrame:
    """Flag rows whose score is strictly above the quantile ``1 - share``."""
    threshold = exact_quantile(df, score, 1 - share)
    return df.withColumn(flag, F.col(score) > F.lit(threshold).cast("double"))
