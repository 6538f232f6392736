"""Operators for training-data pipelines. Nothing else in the package imports this subpackage.

Functions that run inside tasks travel by value, so the workers need no copy of this package.
"""
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
