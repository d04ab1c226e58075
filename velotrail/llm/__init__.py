"""Operators of a training-data pipeline over documents."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers as code, so that executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
