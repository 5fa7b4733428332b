"""Operators for preparing training text.

Functions of this subpackage travel to the executors by value, so that a cluster needs no copy of the library there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
