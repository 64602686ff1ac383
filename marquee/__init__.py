"""Rating analytics and recommendations expressed as Spark jobs."""

import sys

from pyspark import cloudpickle

# Functions of this package travel with the jobs, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
