"""Operators for preparing training text.

Functions of this package that run in tasks travel with the job, so executors need numpy and pyarrow
but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
