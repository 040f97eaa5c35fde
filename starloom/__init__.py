"""starloom: sky catalogs and light curves as Spark jobs.

Everything is a function from DataFrame to DataFrame.  ``operators`` holds the
set-level work (joins, matching, nesting, statistics, period scans),
``functions`` holds Column expressions, ``sources`` holds readers and writers,
``streaming`` the incremental jobs and ``plans`` ready-made compositions and
the checked query list.
"""

import sys

from pyspark import cloudpickle

# The functions of this package that run in tasks travel by value, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
