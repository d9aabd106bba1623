"""Operators for preparing training data, their queries and their SQL.

Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Python workers need not have the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
