"""Operators a training-data pipeline needs; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to executors by value, which so need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
