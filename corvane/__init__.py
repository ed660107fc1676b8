"""Text, grouped-statistics, retrieval, graph and log operators over Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the tasks, so that it needn't be
# installed or shipped there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
