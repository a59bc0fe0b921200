"""Operators for building training corpora: one module per operator.

Functions of this library travel to executors with the job, by value, and models are
broadcast as plain arrays, so a cluster needs no copy of it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules["fleetquill"])
