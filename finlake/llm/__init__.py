"""Operators for large training-data pipelines, and the queries that apply them to whole tables."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to executors by value, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
