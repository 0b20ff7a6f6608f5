"""Operators for preparing training data. Nothing outside this package imports it.

Functions of this package that run in Spark's Python workers are shipped with the job, so executors need not have the
library installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
