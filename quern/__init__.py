"""quern: a Spark-native engine for preparing and analysing text corpora."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers are sent to them whole, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
