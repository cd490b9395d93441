"""Operators that prepare training text, each a function from DataFrames to DataFrames."""

from pyspark import cloudpickle

import verbamark

# the package's own functions travel with the task, so that executors need no
# copy of it installed
cloudpickle.register_pickle_by_value(verbamark)
