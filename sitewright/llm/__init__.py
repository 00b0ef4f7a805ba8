"""Operators for preparing training text at scale; nothing else in the package imports this subpackage.

Functions that run inside tasks are shipped by value, so executors need no copy of the package.
"""
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
