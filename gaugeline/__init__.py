"""Windowed telemetry scoring and alerting as plain Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

from gaugeline.session import build_session, scratch_dir

# Scoring functions travel to the workers by value: executors need NumPy, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "scratch_dir"]
