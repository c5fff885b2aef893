"""Themeloom: topic modelling and text analytics over tables of documents, on PySpark."""

import sys

from pyspark import cloudpickle

# The small functions that run inside tasks travel with the job, so executors need no installed
# copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
