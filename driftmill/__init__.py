"""driftmill: a PySpark-native engine for corpora of saved web documents."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

__version__ = "0.1.0"

# Functions that run on executors travel by value, so no executor needs this package installed.
register_pickle_by_value(sys.modules[__name__])
