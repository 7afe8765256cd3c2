"""Dictionary-driven text annotation and training-data preparation on Spark."""

import sys

from pyspark import cloudpickle

# Functions shipped to executors are pickled with their code, so executors need no copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
