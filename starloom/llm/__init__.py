"""Operators for training-data pipelines over documents, vectors and web pages.

Nothing else in the library imports this package.  Each module holds one
operator with a general interface; ``queries`` registers them over the tables.
"""

import sys

from pyspark import cloudpickle

# Python workers get the functions of this package with the job, so that they need no copy of it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
