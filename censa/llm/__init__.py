"""Operators for large training-data pipelines.

Nothing outside this package imports it. Each module is one operator over a
table of texts; ``queries`` holds the registered queries.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Python workers need not have this package installed: its code goes with the task.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
