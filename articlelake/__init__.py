"""Web-article analytics as Spark jobs."""

import sys

from pyspark import cloudpickle

# The few Arrow functions travel to the workers by value, so executors do not
# need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
