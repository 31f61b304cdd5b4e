"""tallybook: analytics operators for business data, written as Spark jobs."""

import sys

from pyspark import cloudpickle

# task functions travel with the job, so that the package need not be installed on the executors
cloudpickle.register_pickle_by_value(sys.modules[__name__])
