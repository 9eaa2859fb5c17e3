"""Kontor: entity enrichment on Spark.

Turns raw register pages and directory listings into a clean, classified
company directory.  Every operator takes and returns DataFrames (or Columns)
and leaves the physical strategy to Catalyst and adaptive execution.
"""

import sys

from pyspark import cloudpickle

from kontor.session import build_session, drop_scratch, scratch_path, tune

# The few functions that run in Python workers travel with the job, so executors
# need no installation of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "drop_scratch", "scratch_path", "tune"]
