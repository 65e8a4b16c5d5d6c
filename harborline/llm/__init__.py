"""Training-data operators: packing, deduplication, filtering, scoring.

Nothing else in the library imports this package.  Its functions are pickled
by value, so executors need no copy of it on their own import path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
