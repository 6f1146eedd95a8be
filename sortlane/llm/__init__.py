"""Training-data operators: thirteen corpus operators over the public tables.

Nothing else in the library imports this subpackage.  Functions that run in
Python workers are shipped by value, so executors need numpy and pyarrow but
no copy of this package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
