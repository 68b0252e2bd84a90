"""Practice analytics on Spark: extract, link, score and explore training recipes."""

import sys

from pyspark import cloudpickle

# Batch functions travel to the executors by value, so workers need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
