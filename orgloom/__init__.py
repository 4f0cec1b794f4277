"""Organizational insights on Spark."""

import sys

from pyspark import cloudpickle

# Executors get functions by value, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
