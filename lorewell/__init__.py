"""Spark-native analytics over encyclopedia dumps and knowledge graphs.

Python functions of this package are sent to executors by value, so a cluster
does not need the package installed on its workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
