"""Training-data pipeline operators: filtering, mixing, dedup, scoring, archives."""

import sys

from pyspark import cloudpickle

# Task functions travel with their module's code, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
