"""Training-data operators. Nothing else in the library imports this subpackage.

Task functions are sent to the executors by value, so a cluster needs no copy of
this package on the workers' path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
