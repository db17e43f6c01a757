"""Operators for training-data pipelines.  Nothing outside this package imports it.

Functions of this package travel to executors by value, so the package needs
to be installed on the driver only.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
