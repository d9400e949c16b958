"""Cohort analytics over longitudinal coded event records, as Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

# The few functions that run in Python workers travel by value, so executors need pandas and
# pyarrow but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
