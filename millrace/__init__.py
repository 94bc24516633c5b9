"""Spark-first analytics for a web shop: ingest, cleaning, aggregates, streams, vectors."""

import sys

from pyspark import cloudpickle

# Functions travel to Python workers by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
