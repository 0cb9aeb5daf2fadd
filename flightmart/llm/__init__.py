"""Operators for training-data pipelines: scoring, formatting, filtering,
de-duplication, mixing and tokenising of large document tables.

Nothing outside this folder imports it.  Its functions travel to the
executors by value, so a cluster needs no copy of the package on its
workers' paths.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
