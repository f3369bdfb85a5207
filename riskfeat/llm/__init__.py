"""Operators for preparing a training corpus, their queries and the SQL that checks them.

Functions of this package run inside Python workers; they travel there by value, so executors
need Spark's own Python libraries and those the operators name, but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
