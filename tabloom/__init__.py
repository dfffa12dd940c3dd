"""Table, text, series, vector and stream operators written for Apache Spark."""

import sys

from pyspark import cloudpickle

from tabloom.session import build_session, load, scratch_dir

__all__ = ["build_session", "load", "scratch_dir"]

# Functions sent to executors carry their code, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
