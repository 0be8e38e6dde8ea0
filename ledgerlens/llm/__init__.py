"""Operators for large training-data pipelines.

Nothing else in the library imports this subpackage. Functions that run on
executors are shipped by value, so the workers need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
