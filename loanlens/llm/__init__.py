"""Operators of a training-data pipeline: one module per operator, ``registry`` lists their queries.

Task functions of these modules travel to the executors by value, so executors need the libraries they
import but not this package itself.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
