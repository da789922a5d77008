"""Headline tables from raw web pages, on Spark DataFrames.

Stages: land pages, extract headline rows, publish partitioned tables,
classify the titles, report on the classifier. Each step takes and returns
DataFrames; the same extraction code serves batch and streaming input.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with their code, so executors need only
# Spark's own Python packages.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
