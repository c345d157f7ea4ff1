"""Operations of a training-data pipeline, on Spark.

One module per operator; ``queries.py`` registers them as ``opN_<name>``.
Functions that run inside Spark tasks are shipped by value, so executors
need the third-party libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
