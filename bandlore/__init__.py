"""Profiling, modelling, scoring and explaining fixed-width signal tables on Spark."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions sent to executors carry their code, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
