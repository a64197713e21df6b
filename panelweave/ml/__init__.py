"""Models through MLlib, and what is scanned or mapped in numpy beside them."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions that run in Python workers carry their code with them, so that executors need no copy of this package.
register_pickle_by_value(sys.modules[__name__])
