"""Trip-record analytics on Spark: DataFrame in, DataFrame out."""

import sys

from pyspark import cloudpickle

# The few functions that run in Python workers travel with their tasks, so executors do not need
# this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
