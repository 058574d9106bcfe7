"""Training-data operators: tokenising, packing, filtering, de-duplication
and search over the corpus tables.  Nothing else in the library imports this
subpackage.

Functions that run inside tasks travel with the job, so executors need the
libraries they use but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
