"""Operators of a training-data pipeline. Nothing else in the package imports this subpackage."""

import sys

from pyspark import cloudpickle

# Executors get the operators' functions by value, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
