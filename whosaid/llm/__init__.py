"""Operators for training data; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Workers get the helpers with the task, so they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
