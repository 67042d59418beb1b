"""Operators of a training-data pipeline, and the queries that apply them to whole tables.

Functions of this package that run in Python workers are sent along with the tasks, so
executors need not have it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
