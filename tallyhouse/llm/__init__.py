"""Operators for preparing text corpora, each a function from DataFrames to a DataFrame."""

import sys

from pyspark import cloudpickle

# Functions of this package travel with the job: executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
