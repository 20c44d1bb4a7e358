"""Corpus preparation and evaluation operators on Spark DataFrames."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions used in Python workers travel with the job, so that the package
# need not be installed on, or shipped to, the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
