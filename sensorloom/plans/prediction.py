"""Next-hour value prediction: features, temporal split, forest, metrics, prediction table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from sensorloom.operators.boosting import Boosting, fit_side_by_side
from sensorloom.operators.features import feature_names, temporal_split, ts_features
from sensorloom.operators.metrics import regression_metrics, residual_table
from sensorloom.operators.regression import compare_models, fit_forest, predict
from sensorloom.operators.relational import drop_if_present, min_rows, require
from sensorloom.operators.windows import sequential_id
from sensorloom.session import settle
from sensorloom.sources.tables import truncate_append

MIN_ROWS = 100
PREDICTION_SCHEMA = (
    "id bigint, mesure_le timestamp_ntz, ville_id int, temp_reelle double, temp_predite double, erreur double, inserted_at timestamp_ntz"
)


def predict_series(
    df: DataFrame, key: str, ts: str, value: str, covariates: Sequence[str], tiebreak: Sequence[str] = (),
    complete_first: Sequence[str] = (), min_count: int = MIN_ROWS, **params,
) -> tuple[DataFrame, DataFrame] | None:
    """Predictions on the last fifth of the time range, and their metrics; None for too little data.

    The feature table is written once; the quantile, the training and the scoring read it.
    """
    # rows that cannot be trained on do not count
    if not min_rows(require(df, *complete_first) if complete_first else df, min_count):
        return None
    features = settle(ts_features(df, key, ts, value, tiebreak, covariates, complete_first=complete_first))
    train, test, _ = temporal_split(features, ts)
    model = fit_forest(train, feature_names(key, value, covariates), value, **params)
    scored = predict(model, test)
    return residual_table(scored, [ts, key], value, "predicted"), regression_metrics(scored, value, "predicted")


def write_predictions(predictions: DataFrame, table: str, at) -> None:
    """Refill the prediction table; ``at`` is the insert time of the run. Rows are numbered by time and city."""
    names = ["mesure_le", "ville_id", "temp_reelle", "temp_predite", "erreur"]
    numbered = sequential_id(predictions.toDF(*names), names)
    truncate_append(numbered.withColumn("inserted_at", F.lit(at).cast("timestamp_ntz")), table, PREDICTION_SCHEMA)


def compare_tree_models(
    df: DataFrame, key: str, ts: str, value: str, covariates: Sequence[str], tiebreak: Sequence[str] = (),
    forest_params: dict | None = None, boosted_params: dict | None = None, bins: int = 255,
) -> DataFrame:
    """Forest, boosted trees that split node by node, and boosted symmetric trees on the same split; lags are taken over rows with gaps."""
    df = drop_if_present(df, "station_timezone")
    features = settle(ts_features(df, key, ts, value, tiebreak, covariates))
    train, test, _ = temporal_split(features, ts)
    names = feature_names(key, value, covariates)
    growth = {
        "boosted": Boosting(**(boosted_params or {})),
        "symmetric": Boosting(**{"reg": 3.0, **(boosted_params or {}), "symmetric": True}),
    }
    models = {"forest": fit_forest(train, names, value, **(forest_params or {})), **fit_side_by_side(train, names, value, growth, bins)}
    return compare_models(test, value, models)
