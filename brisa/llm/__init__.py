"""Operators for training-data pipelines: filters, duplicates, mixing, counting and scoring of text at scale.

Nothing else in the library imports this package. Functions that run inside tasks travel by value, so
executors need numpy and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
