"""Operators for preparing large text corpora, one module each; nothing else in the library imports this package.

Functions that run inside tasks travel by value, so executors need the public libraries but not this package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
