"""Operators for preparing training data.

The functions that tasks run are pickled by value, so executors need the
libraries they use, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
