"""Operators for preparing large text corpora; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel by value, so executors do not need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
