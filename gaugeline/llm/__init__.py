"""Operators for training-data pipelines: one module per operator, queries in ``queries``."""

import sys

from pyspark import cloudpickle

# Executors need NumPy, pandas and Arrow, not this package: functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
