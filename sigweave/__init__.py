"""Pairing of signalling messages and session enrichment on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# The few functions that run in Python workers travel with the job, so that the package need
# not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
