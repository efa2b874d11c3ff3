"""Spatial gene-count and single-cell lineage analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Helper functions used inside pandas UDFs travel with the task, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
