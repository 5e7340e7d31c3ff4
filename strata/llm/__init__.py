"""Training-data operators: extraction, filtering, deduplication, formatting."""

import sys

from pyspark import cloudpickle

# Tasks get these modules' functions with the job: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
