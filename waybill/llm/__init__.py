"""Operators for preparing training text. Nothing else in the package imports this folder."""

import sys

from pyspark import cloudpickle

# Python tasks get these functions by value, so workers need no copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
