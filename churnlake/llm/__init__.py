"""Operators of a training-data pipeline: filters, duplicates, personal data, language, mixing, packing, search."""

import sys

from pyspark import cloudpickle

# Functions for executors are sent whole, so that executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
