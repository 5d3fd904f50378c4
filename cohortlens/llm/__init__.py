"""Operators for preparing training text: thirteen self-contained modules plus their queries.

Nothing else in the library imports this subpackage.  Functions that run inside
Python workers are pickled by value, so the executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
