"""Training-data operators: deduplication, archives, secrets, packing, token scans, language ID.

Nothing else in the library imports this subpackage.  Functions that run on executors are shipped
by value, so a cluster needs no copy of this code on its workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
