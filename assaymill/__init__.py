"""assaymill: Spark-native mining of papers, protocols and expression measurements."""

import sys

from pyspark import cloudpickle

# Helpers that run inside tasks travel with the task, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
