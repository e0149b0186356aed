"""Operators for large text corpora: dedup, scoring, mixing, packing, linking."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so that those need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
