"""Operators of large training-data pipelines.

Functions of this package travel to executors by value, so that a cluster
needs no copy of it on the executors' Python path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
