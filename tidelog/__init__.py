"""Change-data-capture analytics on Spark DataFrames and Structured Streaming."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The few functions that run inside tasks travel with them, so executors need
# no installation of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
