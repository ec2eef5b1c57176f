"""Operators for preparing training data: dedup, scoring, mixing and packing of documents."""

import sys

from pyspark import cloudpickle

# task functions travel with the job, so executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
