"""wardpulse: NEWS2 vital-signs scoring and analytics as Spark jobs.

Functions and classes of this package that run inside Python workers (Arrow
codecs, the stateful alert processor) are pickled *by value*, so executors do
not need the package installed or shipped as a file.
"""

from pyspark import cloudpickle as _cloudpickle
import sys as _sys

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
