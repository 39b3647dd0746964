"""Operators on corpora of documents: filtering, deduplication, scoring, packing."""

import sys

from pyspark import cloudpickle

# Task functions travel inside the job, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
