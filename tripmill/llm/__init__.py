"""Operators that prepare text for training: dedup, decontamination, scoring, packing, search.

Nothing outside this package imports it. Its functions travel to the executors by value, so
a cluster needs no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
