"""Prepare tables and streams for time-series storage, on Spark."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Arrow functions travel to executors by value, so the package need not be
# installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
