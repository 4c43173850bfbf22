"""Operators for training-data pipelines: filters, deduplication, mixing, packing and archives."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel whole, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
