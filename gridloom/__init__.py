"""Gridded simulation output and multi-run time series as Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers travel by value, so the package need not be
# installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
