"""Operators for preparing language-model training data.

Functions that run inside tasks are sent by value, so executors need numpy, pyarrow and the
few named libraries, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
