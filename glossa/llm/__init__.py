"""Operators for corpora of training text. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Tasks get the code with the job, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
