"""Operators for building a large training corpus, and the queries that apply them.

Nothing else in the library imports this subpackage.  Functions that run inside
Spark tasks are shipped by value, so executors need the installed public
libraries but not this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
