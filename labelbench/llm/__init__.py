"""Operators for preparing training text. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions travel to the executors with their code, so those need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
