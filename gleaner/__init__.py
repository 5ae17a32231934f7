"""Finds, validates and promotes software links in text, with DataFrame operators on Spark."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel by value: the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
