"""Operators for preparing training data; nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# Task functions travel with the job, so executors need no copy of this repository.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
