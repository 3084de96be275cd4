"""Operators of a training-data pipeline: deduplication, quality, scoring, sharding, mixing, tokens, archives."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers by value, so executors need no copy of it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
