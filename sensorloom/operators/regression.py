"""Random forest, and the comparison of models on the same rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from sensorloom.operators.boosting import BoostedModel
from sensorloom.operators.forest import ForestModel, RandomForest
from sensorloom.operators.metrics import compare_predictions


def forest(features: Sequence[str], target: str, trees: int = 100, depth: int = 30, seed: int = 42, **params) -> RandomForest:
    """Random forest that tries all features at each split, with trees of up to 30 levels."""
    return RandomForest(list(features), target, trees, depth, seed, **params)


def fit_forest(train: DataFrame, features: Sequence[str], target: str, **params) -> ForestModel:
    return forest(features, target, **params).fit(train)


def predict(model: ForestModel | BoostedModel, df: DataFrame, name: str = "predicted") -> DataFrame:
    return model.transform(df).withColumnRenamed("predicted", name)


def compare_models(test: DataFrame, target: str, models: dict[str, ForestModel | BoostedModel]) -> DataFrame:
    """Metrics on the test rows, one row per named model, rounded to 4 digits.

    All models score the test rows side by side, so the rows are read once.
    """
    scored, columns = test, {}
    for i, (name, model) in enumerate(models.items()):
        columns[name] = f"_predicted_{i}"
        scored = predict(model, scored, columns[name])
    return compare_predictions(scored, target, columns)
