"""Operators of a training-data pipeline; nothing outside this package imports it.

Functions that run in Python workers are shipped by value, so executors need the libraries
(numpy, pandas, zstandard, tiktoken) but not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
