"""Operators for training-data pipelines. Nothing else in the package imports this folder."""

import sys

from pyspark import cloudpickle

# Tasks get these functions by value, so the package need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
