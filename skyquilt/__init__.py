"""Earth-observation and tabular analytics as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# functions that run in tasks travel with the job: executors needn't have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
