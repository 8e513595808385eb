"""Operators for preparing training text: scans, deduplication, scoring, formatting and mixing."""

import sys

from pyspark import cloudpickle

# functions of this package travel to the tasks by value: the executors need no copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
