"""Operators for preparing training data: one module each, with queries and oracle SQL beside them."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code, so that these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
