"""Operators of a training-data pipeline; nothing else in the library imports them.

What a task needs of this subpackage travels with the task, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
