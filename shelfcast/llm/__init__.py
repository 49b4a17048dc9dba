"""Operators for preparing training text at scale; nothing outside imports this package.

Functions of this package that run in Python workers travel with the job (by value),
so executors need no installed copy of it.
"""
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
