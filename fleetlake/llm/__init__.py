"""Operators for preparing large text corpora; nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job: executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
