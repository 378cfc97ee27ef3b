"""Retail lakehouse, data-observability and training-data operators on Spark."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # functions go to the workers whole: they need no copy of the package
