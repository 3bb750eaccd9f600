"""tsubo: listing analytics as composable PySpark DataFrame operators."""

import sys

from pyspark import cloudpickle

# The few functions that run in Python workers travel with their job, so the
# executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
