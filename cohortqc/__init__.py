"""cohortqc: a PySpark-native engine for quality control of genetic cohorts and for preparing large record sets."""

import sys

from pyspark import cloudpickle

# functions that run on executors travel with the job, so the package need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
