"""Operators on training text: ten operators, their queries and SQL texts.

Nothing else in the package imports this folder. Its functions travel to the
executors by value, so these need Python libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
