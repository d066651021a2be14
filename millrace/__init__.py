"""Stream- and table-processing operators written as Spark DataFrame transformations."""

import sys

from pyspark import cloudpickle

from millrace.ordered import Ordered
from millrace.session import local_session, shared_dir

# Functions that run in Python workers travel with the job, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Ordered", "local_session", "shared_dir"]
