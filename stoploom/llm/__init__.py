"""Operators of a training-data pipeline; each module holds one of them."""

import sys

from pyspark import cloudpickle

# tasks get these functions by value, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
