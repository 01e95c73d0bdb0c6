"""chorale: preparing labelled corpora and measuring models on them, in Spark."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the plan, so executors need
# no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
