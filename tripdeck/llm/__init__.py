"""Operators for preparing language-model training data, each a DataFrame → DataFrame job.

Functions that run inside Spark tasks are pickled by value, so executors need numpy, pyarrow
and the codec libraries, but no copy of this package on their import path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
