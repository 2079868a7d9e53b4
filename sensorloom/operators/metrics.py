"""Regression metrics, residuals and model comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from sensorloom.functions import values as fv
from sensorloom.operators.joins import to_long


def regression_metrics(
    df: DataFrame, y: str, yhat: str, by: Sequence[str] = (), digits: int | None = None
) -> DataFrame:
    """MAE, RMSE, MAPE in percent (zero targets left out) and R2 in one aggregation.

    MAPE is null without a non-zero target, R2 is null for a constant target.
    """
    error = F.col(y) - F.col(yhat)
    spread = F.var_pop(y) * F.count(y)
    stats = {
        "mae": F.avg(F.abs(error)),
        "rmse": F.sqrt(F.avg(error * error)),
        "mape": F.avg(fv.relative_residual(F.col(y), F.col(yhat))) * 100,
        "r2": F.when(spread > 0, 1 - F.sum(error * error) / spread),
    }
    pairs = df.filter(F.col(y).isNotNull() & F.col(yhat).isNotNull())
    done = pairs.groupBy(*by).agg(*[c.alias(name) for name, c in stats.items()])
    return done if digits is None else fv.round_columns(done, dict.fromkeys(stats, digits))


def residual_table(df: DataFrame, ids: Sequence[str], y: str, yhat: str) -> DataFrame:
    """Identifiers, actual, predicted, and actual minus predicted."""
    error = fv.residual(F.col(y), F.col(yhat))
    return df.select(*ids, F.col(y).alias("actual"), F.col(yhat).alias("predicted"), error.alias("error"))


def compare_predictions(df: DataFrame, y: str, models: dict[str, str], digits: int = 4) -> DataFrame:
    """One row of metrics per model, for ``{model: prediction column}`` of the same rows, in one scan."""
    named = df.select(y, *[F.col(c).cast("double").alias(model) for model, c in models.items()])
    return regression_metrics(to_long(named, [y], list(models), "model", "_yhat"), y, "_yhat", ["model"], digits)
