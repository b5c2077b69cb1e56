"""Operators for preparing training data."""

import sys

from pyspark import cloudpickle

# What tasks run travels with them, so executors need the libraries that it uses but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
