"""Paper-corpus analytics and retrieval as Spark DataFrame plans."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Task functions travel with the job, so a cluster needs no copy of the package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
