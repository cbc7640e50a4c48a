"""Operators that prepare text for training; nothing else in the library imports them.

Functions of this subpackage that run in Python workers are sent by value, so
executors need the listed third-party libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
