"""Retrieval-corpus engine expressed as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions that run inside Arrow tasks travel with the job, so executors do
# not need this package on their own path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
