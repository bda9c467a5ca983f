"""Operators for preparing training text, one module each.

Nothing else in the library imports this subpackage. Its functions run
inside Spark tasks, so they are pickled by value: executors need the listed
third-party packages, but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
