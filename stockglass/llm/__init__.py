"""Operators for large training corpora; nothing else in the package imports them."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with them: executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
