"""Training-data operators for language-model corpora.

Nothing outside this package imports it.  Every operator takes and returns
DataFrames; tasks use numpy / Arrow on batches, Spark does the partitioning,
shuffling and recovery.  Functions that run in Python workers are pickled by
value, so executors need no copy of this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
