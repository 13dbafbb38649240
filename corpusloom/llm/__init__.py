"""Operators for preparing training data: near copies, repeats, leaks, personal data, toxicity, tokens."""

import sys

from pyspark import cloudpickle

# Functions for the tasks are shipped by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
