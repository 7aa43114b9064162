"""quarry: retrieval over document tables, as Spark jobs.

Functions of this package that run inside Spark tasks (pandas UDFs,
``mapInArrow`` kernels) are pickled *by value*, so executors need no copy
of the package installed: the code travels with each task.
"""

from pyspark import cloudpickle as _cloudpickle
import sys as _sys

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
