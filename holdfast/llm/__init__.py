"""Operators of training-data pipelines: filters, near duplicates, search, mixing and packing.

Nothing outside this package and ``corpus_pipeline.py`` imports it. Functions that run in Python
workers travel by value, so executors need no copy of the package on their import path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
