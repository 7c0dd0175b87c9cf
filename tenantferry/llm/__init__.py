"""Operators for the preparation of training data; nothing outside this folder imports them.

Functions of this package that run in tasks travel with the job, so that executors need not have it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
