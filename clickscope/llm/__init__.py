"""Operators for training-data pipelines."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so that they need
# only the public libraries there, not the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
