"""Topic clustering of a daily document feed, written as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the plan: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
