"""Operators that prepare text, page and vector tables for model training."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value: they need no copy of it there.
cloudpickle.register_pickle_by_value(sys.modules["loanweave"])
