"""Operators of a training-data pipeline over documents, pages and embeddings."""

import sys

from pyspark import cloudpickle

# Functions travel to the executors by value: these need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
