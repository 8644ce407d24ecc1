"""Operators that prepare text corpora for training language models.

Functions of this package that run in Python workers are sent by value, so the executors
need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
