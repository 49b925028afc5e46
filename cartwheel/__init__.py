"""cartwheel: retail customer analytics expressed as Spark DataFrame operators.

Layers:
  sources/    reading raw invoice lines, writing/reading stored tables, test-table adapter
  functions/  column-expression helpers (rounding, calendar arithmetic, special functions)
  operators/  reusable DataFrame -> DataFrame operators (cleaning, ranking, RFM, CLV, ...)
  plans/      the user-visible queries (business questions, dashboard datasets, CLV model plans)
  streaming/  the cleaning operator applied to a stream of raw invoice files
"""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks (the CLV model's numpy) are shipped by value: executors need the installed
# public libraries but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
