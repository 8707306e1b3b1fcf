"""Training-data operators: scoring, filtering, de-duplication and mixing of documents.

Functions of this package travel to the executors by value, so a cluster needs no copy of
the package on its Python path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
