"""Operators of a training-data pipeline on Spark; nothing else in the library imports this subpackage.

Functions that run in Python workers are shipped by value, so executors need the third-party packages only.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
