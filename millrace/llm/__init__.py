"""Operators of a training-data pipeline: deduplication, quality, language, mixing and tokens.

Functions of this subpackage that run in tasks travel by value, so executors need the libraries
they use but not the package itself.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
