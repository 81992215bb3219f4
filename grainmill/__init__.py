"""grainmill: a Spark-native analytics engine for generate-validate-evaluate pipeline logs."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions sent to executors travel by value, so a cluster needs no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
