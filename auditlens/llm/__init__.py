"""Training-data operators: mixing, packing, licences, near and exact
duplicates, WARC, language, quality rules, chat rendering, URL filter.

The functions that run in Python workers are pickled by value, so the workers
need not have this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
