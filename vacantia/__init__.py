"""Posting analytics as PySpark table jobs.

Fetched pages, recorded board payloads and recorded answers come in as tables;
posting sets, identities, merge groups, located evidence, work plans, reports
and evaluation metrics go out as DataFrames.
"""

import sys

from pyspark import cloudpickle

from vacantia.session import build_session, cut_lineage, small_side, spread

# Batch functions travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "cut_lineage", "small_side", "spread"]
