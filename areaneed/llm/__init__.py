"""Operators of a training-data pipeline, as Spark jobs over whole tables.

Functions that run inside tasks travel with the job, so executors need numpy and pyarrow but
not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
