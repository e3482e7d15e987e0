"""Queries over the given tables and their DuckDB equivalents."""

import sys

from pyspark import cloudpickle

# As in hirelake: callables reach the executors by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
