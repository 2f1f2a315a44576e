"""Operators for preparing training corpora (see README, "Corpus operators")."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so a session
# works whether or not the package is on the workers' path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
