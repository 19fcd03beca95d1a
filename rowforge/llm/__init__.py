"""Operators for preparing language-model training data, DataFrame to DataFrame.

Nothing else in the package imports this subpackage.  The functions that run
inside tasks travel with the task itself, so executors need no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
