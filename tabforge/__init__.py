"""tabforge: tabular analytics and classical ML as Spark DataFrame jobs.

Declare a :class:`~tabforge.spec.FeatureSpec` for any table, then profile,
clean, encode, scale, split, select features, train, evaluate, cluster,
tune, version and score with set-based DataFrame / ``pyspark.ml`` jobs.
"""

import sys

from pyspark import cloudpickle

from .spec import FeatureSpec, HEART

__all__ = ["FeatureSpec", "HEART"]
__version__ = "0.1.0"

# Functions of this package that run in Python workers travel with the job, so
# executors need no copy of the package on their own path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
