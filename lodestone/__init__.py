"""A Spark-first engine for evidence ranking and corpus preparation."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code with them, so a cluster needs no
# copy of this package on its workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
