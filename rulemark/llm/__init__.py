"""Operators for training corpora: ten jobs over ``documents`` and ``pages``."""

import sys

from pyspark import cloudpickle

# Python tasks get the functions of this package with the job; executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
