"""Operators for preparing language-model training data, with their queries.

Nothing else in the library imports this subpackage. Functions that run in Python workers are
pickled by value, so that executors need not have the repository on their own path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
