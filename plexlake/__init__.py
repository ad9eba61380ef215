"""Isobaric-label quantitative proteomics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Arrow functions travel to the workers by value, so executors need numpy and pandas
# but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
