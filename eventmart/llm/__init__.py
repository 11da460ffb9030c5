"""Operators that prepare training text: filters, de-duplication, extraction, formatting, mixing.

Nothing outside this subpackage imports it.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
