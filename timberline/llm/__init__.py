"""Operators that prepare text for the training of language models. Nothing else in the package imports them.

Functions that run in Python workers travel with the job by value, so executors need not have the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
