"""Operators for large training corpora: mixing, sharding, deduplication, quality, archives, chat."""

import sys

from pyspark import cloudpickle

# Tasks get this package's functions with their closures, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
