"""postmill: analytics jobs for discussion posts, written on PySpark DataFrames."""

import sys

from pyspark import cloudpickle

# Ship our few Arrow functions by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
