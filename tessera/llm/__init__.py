"""Operators for preparing language-model training data.

Nothing else in the library imports this package. Its functions travel to the
executors by value, so that tasks need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
