"""Operators for training-data pipelines over documents, pages and conversations.

Nothing outside this package imports it; ``__spark_entry__.py`` adds its queries if it is there.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions that run in Python workers carry their code with them, so that executors need no copy of this package.
register_pickle_by_value(sys.modules[__name__])
