"""Operators of a large-scale training-data pipeline.

Nothing else in the library imports this package. Python code that runs in
tasks is pickled by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
