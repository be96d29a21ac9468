"""Support-ticket triage, retrieval, intake and evaluation as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
