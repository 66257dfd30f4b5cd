"""Operators of a training-data pipeline; nothing outside this subpackage imports it."""

import sys

from pyspark import cloudpickle

# Task functions travel to the executors whole, which then need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
