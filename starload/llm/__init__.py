"""Operators for training-data pipelines. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions of this package that run in tasks travel with the task, so that executors need no
# copy of the package of their own.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
