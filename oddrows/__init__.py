"""oddrows: find unusual rows, time steps and sequences with Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Small helpers used inside tasks travel with the task, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
