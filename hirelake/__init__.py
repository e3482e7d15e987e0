"""Spark library that turns raw job postings into labour-market tables."""

import sys

from pyspark import cloudpickle

# Functions handed to mapInPandas travel by value, so executors do not need
# this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
