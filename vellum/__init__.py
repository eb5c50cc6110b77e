"""vellum: a Spark-native document + retail analytics pipeline.

Layers:
  sources/    readers: driver tables, stage listings, staged domain files
  functions/  column expressions (path parts, ids, number parsing, JSON paths, geo points)
  operators/  DataFrame operators (catalog appends, text extraction, curation, lake, joins)
  plans/      fixture views, the final integrated view, the query registry and its SQL oracles
  streaming/  the incremental steps T1 -> T2 -> T3 and the run log
"""

import sys as _sys

# Functions of this package that run inside tasks (pandas UDFs, mapInPandas
# bodies) are shipped to executors by value, so workers need no copy of the
# package on their import path.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # older cloudpickle: ship the package with --py-files
    pass

__all__ = ["session"]
