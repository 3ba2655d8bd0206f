"""Training-data operators: ten stages of a text-corpus pipeline on Spark.

Each module holds one operator with its general interface; ``queries`` binds
them to the driver tables.  Nothing outside this subpackage imports it (the
driver contract adds its queries only when it is present).
"""

import sys

from pyspark import cloudpickle

# Kernels travel to the executors by value: workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
