"""Statistics, mining and machine-learning jobs as PySpark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers travel with their code, so that a job started
# from any folder runs on workers that do not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
