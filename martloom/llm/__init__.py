"""Operators and a pipeline for training text: ten operators, their queries and SQL.

Nothing else in the library imports this package. Functions that run in Python
workers are sent by value, so executors need Python, numpy and Arrow but not this
package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
