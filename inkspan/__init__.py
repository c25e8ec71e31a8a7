"""inkspan: documents to searchable vector tables, on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions of this package travel inside the tasks that use them, so a cluster
# needs no copy of the package on its workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
