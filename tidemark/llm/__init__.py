"""Training-data operators: classification, near-duplicate search, packing,
formatting, tokenisation and vector search.

Every operator is a function ``DataFrame -> DataFrame`` with its own general
interface. ``queries.py`` binds them to the given tables with production
parameters. Nothing outside this package imports it.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the Python workers by value, so a
# worker needs none of it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
