"""Operators for large-scale training-data pipelines.

Nothing else in the library imports this subpackage. Functions that run
inside Python workers are sent by value, so the workers need no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
