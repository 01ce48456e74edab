"""Operators for building language-model training data, each as a Spark job.

Nothing else in the library imports this subpackage. ``catalog`` holds the registered queries
and their DuckDB SQL.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Python functions of this subpackage travel to the executors whole, so that a cluster needs no
# copy of it installed there.
register_pickle_by_value(sys.modules[__name__])
