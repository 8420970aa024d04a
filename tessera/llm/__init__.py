"""Operators for preparing training data at scale.

Functions of this package run inside Python workers; they are shipped by value, so
executors need numpy, pandas and pyarrow but not an installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
