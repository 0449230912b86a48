"""Operators of a training-data pipeline, one module each; see the README.

Functions that run in tasks are sent to executors by value, so executors need numpy and pyarrow but
not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
