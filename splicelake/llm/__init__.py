"""Operators for large training-data pipelines.

Nothing else in the library imports this subpackage. ``registry`` lists the
queries that ``__spark_entry__.py`` offers when the subpackage is present.
Functions that run in tasks are pickled whole, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
