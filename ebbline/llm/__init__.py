"""Operators for preparing language-model training data at corpus scale."""
import sys

from pyspark import cloudpickle

# Python tasks get this package's functions by value, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
