"""Catalogue similarity and text clustering as PySpark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks are shipped with the job, so executors need
# no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
