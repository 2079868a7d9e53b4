"""Hourly sensor and event analytics as parameterised PySpark DataFrame operators.

functions   column expressions (Column -> Column), all evaluated in the JVM
operators   joins, aggregates, windows, features, metrics, models, checks
sources     feeds, delimited files, tables, the zone layout
streaming   Structured Streaming jobs
plans       whole pipelines and the query catalogue
"""

import sys

from pyspark import cloudpickle

# functions that run in Python workers travel with the job, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
