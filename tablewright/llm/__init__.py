"""Operators for preparing training data; nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions go to Python workers whole, so that executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
