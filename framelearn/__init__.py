"""Spark jobs for the data work around machine learning."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions that run inside tasks travel with the job, so executors need numpy
# and pyarrow but not this package on their path.
register_pickle_by_value(sys.modules[__name__])
