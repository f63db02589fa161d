"""Operators for preparing large text collections for model training.

The functions that tasks run are sent with the tasks, so that executors need the
libraries that these operators use but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
