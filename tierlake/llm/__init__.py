"""Training-data operators. Nothing outside this package imports it.

Functions that run in Python workers are pickled by value, so executors need
only the Python libraries, not a copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
