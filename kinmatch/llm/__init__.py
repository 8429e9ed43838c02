"""Operators that prepare training corpora; nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel whole, so executors needn't have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
