"""Supervised learning and model evaluation as Spark jobs over DataFrames."""

import sys

from pyspark import cloudpickle

# Functions run inside tasks are shipped with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
