"""Query catalogue: every operator run over the whole test tables, with the same query in SQL.

The operators were written for hourly measurements of cities. Here ``events`` plays the measurements (a user
stands for a city), ``customer`` and ``nation`` the dimensions, ``lineitem`` the numeric features.
"""

from sensorloom.plans.catalog import aggregates, feeds, models, relations, scalars, series, streams  # noqa: F401
from sensorloom.plans.catalog.registry import coverage, oracles, queries

__all__ = ["coverage", "oracles", "queries"]
